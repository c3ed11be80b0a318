"""Queries that put the driver tables in the roles of samples, depths, series and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandwise.functions import scalars as S
from strandwise.operators import cohort as C
from strandwise.operators import dynamics as D
from strandwise.operators import intervals as I
from strandwise.operators import relational as R
from strandwise.plans.base import MINUTE_SQL, Tables, long, minute_of_month, query, sql_q6

_METRICS = "(SELECT c_custkey, c_acctbal AS bal, n, mean, hi FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, avg(o_totalprice) AS mean, count(*) FILTER (o_orderpriority = '1-URGENT') AS hi FROM orders GROUP BY 1) ON c_custkey = o_custkey)"


def _metrics(t: Tables) -> DataFrame:
    o = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"), F.avg("o_totalprice").alias("mean"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("hi"))
    return t.customer.select("c_custkey", F.col("c_acctbal").alias("bal")).join(o, "c_custkey", "left").select("c_custkey", "bal", "n", "mean", "hi")


_FLAGS = """list_filter([CASE WHEN n < 10 THEN 'LOW_DEPTH' END, CASE WHEN bal < 90 THEN 'LOW_BREADTH' END, CASE WHEN hi > 4 THEN 'HIGH_DUP' END], lambda x: x IS NOT NULL)"""
_VERDICTS = f"""(SELECT c_custkey, f, CASE WHEN list_has_any(f, ['NO_DATA', 'LOW_DEPTH', 'LOW_BREADTH', 'HIGH_MISSING']) THEN 'FAIL' WHEN len(f) > 0 THEN 'WARN' ELSE 'PASS' END AS verdict FROM (SELECT c_custkey, {_FLAGS} AS f FROM {_METRICS}))"""


def _verdicts(t: Tables) -> DataFrame:
    f = C.qc_flags({"depth": F.col("n"), "breadth": F.col("bal"), "dup": F.col("hi")}, C.QcThresholds(dup=4))
    return _metrics(t).select("c_custkey", f.alias("f")).withColumn("verdict", C.verdict(F.col("f")))


@query(f"SELECT c_custkey, array_to_string(f, ';') AS flags, verdict FROM {_VERDICTS}")
def qc_verdict(t: Tables) -> DataFrame:
    return _verdicts(t).select("c_custkey", F.array_join("f", ";").alias("flags"), "verdict")


@query(f"SELECT c_custkey, verdict, rank() OVER (ORDER BY CASE verdict WHEN 'FAIL' THEN 0 WHEN 'WARN' THEN 1 ELSE 2 END) AS place FROM {_VERDICTS}")
def flags_sorted_sink(t: Tables) -> DataFrame:
    v = _verdicts(t).withColumn("s", C.severity(F.col("verdict")))
    before = v.groupBy("s").agg(F.count(F.lit(1)).alias("n"))  # three rows
    place = before.withColumn("place", F.coalesce(F.sum("n").over(Window.orderBy("s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + 1)
    return v.join(F.broadcast(place.select("s", "place")), "s").select("c_custkey", "verdict", "place")


@query(f"""SELECT c_custkey, array_to_string(list_filter([CASE WHEN hi > 3 THEN 'HIGH_IMPACT_EXCESS' END, CASE WHEN bal / 5000 > 1 THEN 'PNPS_PROXY_HIGH' END, CASE WHEN n < 12 THEN 'ANNOTATION_POOR' END], lambda x: x IS NOT NULL), ';') AS more FROM {_METRICS}""")
def live_reflag(t: Tables) -> DataFrame:
    m = {"high_z": F.col("hi"), "pnps": F.col("bal") / 5000, "annotated": F.when(F.col("n") < 12, 0.0).otherwise(100.0)}
    return _metrics(t).select("c_custkey", F.when(F.col("n").isNull(), F.array_join(C.live_flags({k: v for k, v in m.items() if k != "annotated"}), ";")).otherwise(F.array_join(C.live_flags(m), ";")).alias("more"))


@query("SELECT c_custkey FROM customer WHERE c_acctbal >= 100 AND c_custkey BETWEEN 50 AND 900 AND contains(lower(c_mktsegment), 'build') AND c_nationkey < 20")
def column_filter_grammar(t: Tables) -> DataFrame:
    typed = {"c_acctbal": ">= 100", "c_custkey": "50..900", "c_mktsegment": "BUILD", "c_nationkey": "<20"}
    out = t.customer
    for c, text in typed.items():
        out = out.where(C.compile_filter(F.col(c), text))
    return out.select("c_custkey")


@query("""SELECT l_suppkey, count(*) FILTER (k IN ('AF', 'FA')) AS ti, count(*) FILTER (k NOT IN ('AF', 'FA', 'NO')) AS tv, """ + sql_q6("CASE WHEN count(*) FILTER (k NOT IN ('AF', 'FA', 'NO')) > 0 THEN count(*) FILTER (k IN ('AF', 'FA'))::DOUBLE / count(*) FILTER (k NOT IN ('AF', 'FA', 'NO')) END") + " AS titv FROM (SELECT l_suppkey, l_returnflag || l_linestatus AS k FROM lineitem) GROUP BY 1")
def ti_tv_counters(t: Tables) -> DataFrame:
    k = F.concat("l_returnflag", "l_linestatus")
    g = t.lineitem.groupBy("l_suppkey").agg(F.count_if(k.isin("AF", "FA")).alias("ti"), F.count_if(~k.isin("AF", "FA", "NO")).alias("tv"))
    return g.withColumn("titv", S.q6(F.col("ti") / F.when(F.col("tv") > 0, F.col("tv"))))


@query("""WITH x AS (SELECT s_nationkey, l_partkey % 60 AS gene, l_returnflag AS e, CASE WHEN l_linenumber = 1 THEN 'HIGH' WHEN l_linenumber < 4 THEN 'MODERATE' ELSE 'LOW' END AS impact FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
e AS (SELECT s_nationkey, gene, e, count(*) AS n FROM x GROUP BY ALL), d AS (SELECT s_nationkey, gene, arg_min(e, (-n, e)) AS effect FROM e GROUP BY ALL),
g AS (SELECT s_nationkey, gene, count(*) FILTER (impact = 'HIGH') AS high, count(*) FILTER (impact = 'MODERATE') AS moderate FROM x GROUP BY ALL)
SELECT * FROM (SELECT s_nationkey, gene, high, moderate, effect, row_number() OVER (PARTITION BY s_nationkey ORDER BY high DESC, moderate DESC, gene)::INT AS nth FROM g JOIN d USING (s_nationkey, gene)) WHERE nth <= 10""")
def gene_burden_topk(t: Tables) -> DataFrame:
    impact = F.when(F.col("l_linenumber") == 1, "HIGH").when(F.col("l_linenumber") < 4, "MODERATE").otherwise("LOW")
    x = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select("s_nationkey", (F.col("l_partkey") % 60).alias("gene"), F.col("l_returnflag").alias("e"), impact.alias("impact"))
    return C.burden(x, "s_nationkey", "gene", "impact", "e", 10).select("s_nationkey", "gene", "high", "moderate", "effect", "nth")


@query("""WITH b AS (SELECT l_returnflag, least(199, ((date_diff('day', DATE '1992-01-01', l_shipdate::DATE)) * 200 // 4000))::BIGINT AS bin, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT f AS l_returnflag, i::BIGINT AS bin, coalesce(n, 0) AS n FROM (SELECT DISTINCT l_returnflag AS f FROM lineitem), range(0, 200) r(i) LEFT JOIN b ON b.l_returnflag = f AND b.bin = i""")
def profile_bins(t: Tables) -> DataFrame:
    place = F.datediff(F.to_date("l_shipdate"), F.lit("1992-01-01").cast("date"))
    b = I.profile_bins(t.lineitem, ["l_returnflag"], place, 4000)
    return I.dense_fill(b, ["l_returnflag"], "bin", 0, 199, {"n": 0})


@query("""WITH h AS (SELECT user_id % 10 AS k, d AS depth, count(*) AS n FROM (SELECT user_id, day(ts) AS day, count(*) AS d FROM events GROUP BY ALL) GROUP BY ALL),
o AS (SELECT k, sum(n) AS cov, sum(n * depth)::DOUBLE AS s1, sum(n * depth * depth)::DOUBLE AS s2, sum(n) FILTER (depth >= 2) AS at2, greatest(0, 450 - sum(n)) AS zero FROM h GROUP BY k),
r AS (SELECT k, depth, sum(n) OVER (PARTITION BY k ORDER BY depth) AS run FROM h), m AS (SELECT k, min(depth) FILTER (zero + run >= (cov + zero) / 2) AS med FROM r JOIN o USING (k) GROUP BY k)
SELECT k, """ + sql_q6("100.0 * at2 / (cov + zero)") + " AS breadth, CASE WHEN zero >= (cov + zero) / 2 THEN 0 ELSE med END::BIGINT AS median, " + sql_q6("sqrt(greatest(0.0, s2 / (cov + zero) - (s1 / (cov + zero)) * (s1 / (cov + zero)))) / (s1 / (cov + zero))") + " AS evenness FROM o JOIN m USING (k)")
def cov_histogram(t: Tables) -> DataFrame:
    d = t.events.groupBy("user_id", F.day("ts").alias("day")).agg(F.count(F.lit(1)).alias("depth"))
    h = d.groupBy((F.col("user_id") % 10).alias("k"), "depth").agg(F.count(F.lit(1)).alias("n"))
    return C.cov_histogram(h, ["k"], "depth", "n", F.lit(450), 2).select("k", S.q6("breadth").alias("breadth"), long("median").alias("median"), S.q6("evenness").alias("evenness"))


_HOURS = f"(SELECT {MINUTE_SQL} // 60 + 1 AS pos, count(*) AS dp FROM events GROUP BY 1)"


def _hours(t: Tables) -> DataFrame:
    return t.events.groupBy((F.floor(minute_of_month(F.col("ts")) / 60) + 1).alias("pos")).agg(F.count(F.lit(1)).alias("dp"))


@query(f"SELECT (pos - 1) // 24 AS win, {sql_q6('avg(dp)')} AS mean, {sql_q6('count(*) FILTER (dp = 0)::DOUBLE / count(*)')} AS zero, {sql_q6('count(*) FILTER (dp >= 14)::DOUBLE / count(*)')} AS callable FROM {_HOURS} GROUP BY 1")
def depth_windows(t: Tables) -> DataFrame:
    w = C.windows(_hours(t), [], "pos", "dp", 24, 14)
    return w.select(F.col("window").alias("win"), S.q6("mean").alias("mean"), S.q6("zero").alias("zero"), S.q6("callable").alias("callable"))


@query(f"""WITH g AS (SELECT s_suppkey AS gene, (s_suppkey * 7)::BIGINT AS s, (s_suppkey * 7 + 9)::BIGINT AS e FROM supplier), m AS (SELECT median(dp) AS med FROM {_HOURS})
SELECT gene, {sql_q6('count(*) FILTER (dp > 0)::DOUBLE / count(*)')} AS breadth, {sql_q6('count(*) FILTER (dp >= 14)::DOUBLE / count(*)')} AS callable, {sql_q6('avg(dp)')} AS mean, {sql_q6('avg(dp) / any_value(med)')} AS relative FROM {_HOURS} h JOIN g ON pos BETWEEN s AND e, m GROUP BY 1""")
def gene_depth(t: Tables) -> DataFrame:
    g = t.supplier.select(F.col("s_suppkey").alias("gene"), (F.col("s_suppkey") * 7).alias("s"), (F.col("s_suppkey") * 7 + 9).alias("e"))
    h = _hours(t)
    both = I.interval_join(h, g, [], ("pos", "pos"), ("s", "e"), 16)
    return C.feature_depth(h, both, "gene", "dp", 14).select("gene", *[S.q6(c).alias(c) for c in ("breadth", "callable", "mean", "relative")])


@query(f"""WITH n AS (SELECT p_brand, split_part(replace(p_type || ' ', ' ', '.'), '.', 1) AS main, sum(p_size)::BIGINT AS n FROM part GROUP BY ALL), f AS (SELECT *, n::DOUBLE / sum(n) OVER (PARTITION BY p_brand) AS fr FROM n)
SELECT p_brand, main, n, {sql_q6('fr')} AS fraction, count(*) FILTER (100 * fr >= 2 AND n >= 3) OVER (PARTITION BY p_brand) AS lineages FROM f""")
def lineage_fractions(t: Tables) -> DataFrame:
    lineage = F.translate(F.concat("p_type", F.lit(" ")), " ", ".")
    return C.lineage_fractions(t.part, ["p_brand"], lineage, F.col("p_size")).select("p_brand", "main", long("n").alias("n"), S.q6("fraction").alias("fraction"), "lineages")


@query(f"""WITH c AS (SELECT l_partkey, list(DISTINCT l_suppkey) AS s, {sql_q6('median(l_quantity)')} AS med FROM lineitem GROUP BY 1)
SELECT l_partkey, len(s)::INT AS samples, len(list_filter(s, lambda x: x <> l_partkey % 100))::INT AS others, med FROM c""")
def event_rollup(t: Tables) -> DataFrame:
    c = t.lineitem.groupBy("l_partkey").agg(F.collect_set("l_suppkey").alias("s"), S.q6(F.median("l_quantity")).alias("med"))
    return c.select("l_partkey", F.size("s").alias("samples"), F.size(F.array_except("s", F.array(F.col("l_partkey") % 100))).alias("others"), "med")


@query("""WITH x AS (SELECT o_custkey, unnest(CASE WHEN o_orderkey % 7 = 0 THEN ['F', 'O'] ELSE [o_orderstatus] END) AS drug, left(o_orderpriority, 1)::INT AS g FROM orders)
SELECT o_custkey, min(g) FILTER (drug = 'F') AS "F", min(g) FILTER (drug = 'O') AS "O", min(g) FILTER (drug = 'P') AS "P" FROM x GROUP BY 1""")
def worst_grade_matrix(t: Tables) -> DataFrame:
    label = F.when(F.col("o_orderkey") % 7 == 0, F.lit("F_O")).otherwise(F.col("o_orderstatus"))
    x = t.orders.select("o_custkey", F.explode(C.composite_parts(label, ["F", "O", "P"])).alias("drug"), F.left("o_orderpriority", F.lit(1)).cast("int").alias("g"))
    return C.worst_grades(x, "o_custkey", "drug", "g", ["F", "O", "P"])


@query("""SELECT l_suppkey, CASE WHEN af <= 0.1 THEN 0 WHEN af <= 0.2 THEN 1 WHEN af <= 0.3 THEN 2 WHEN af <= 0.5 THEN 3 WHEN af <= 0.7 THEN 4 ELSE 5 END AS band, count(*) AS n, count(*) FILTER (floor(af * l_quantity + 0.5) <= 3) AS few FROM (SELECT *, l_discount * 8 AS af FROM lineitem) WHERE af > 0 AND af <= 0.9 GROUP BY ALL""")
def minority_bands(t: Tables) -> DataFrame:
    af = F.col("l_discount") * 8
    m = t.lineitem.select("l_suppkey", C.bands(af, C.MINORITY_EDGES).alias("band"), (F.floor(af * F.col("l_quantity") + 0.5) <= 3).alias("few"))
    return m.where("band IS NOT NULL").groupBy("l_suppkey", "band").agg(F.count(F.lit(1)).alias("n"), F.count_if("few").alias("few"))


@query("""WITH s AS (SELECT user_id, json_extract_string(props, '$.k')::BIGINT AS k, avg(value) / 300 AS af, count(*) * 10 AS dp FROM events GROUP BY ALL),
p AS (SELECT x.af, x.dp, y.k IS NOT NULL AS hit FROM s x LEFT JOIN s y ON y.user_id = x.user_id + 1 AND y.k = x.k)
SELECT CASE WHEN af <= 0.1 THEN 0 WHEN af <= 0.2 THEN 1 WHEN af <= 0.3 THEN 2 WHEN af <= 0.5 THEN 3 WHEN af <= 0.7 THEN 4 WHEN af <= 0.9 THEN 5 ELSE 6 END AS band, count(*) AS tested, count(*) FILTER (hit) AS seen FROM p WHERE dp > 7 AND af * dp >= 1 AND af > 0 AND af <= 1 GROUP BY 1""")
def reproducibility(t: Tables) -> DataFrame:
    s = t.events.groupBy("user_id", long(F.get_json_object("props", "$.k")).alias("k")).agg((F.avg("value") / 300).alias("af"), (F.count(F.lit(1)) * 10).alias("dp"))
    other = s.select((F.col("user_id") - 1).alias("user_id"), "k", F.lit(True).alias("hit"))
    return C.reproducibility(s.join(other, ["user_id", "k"], "left").fillna(False, ["hit"]), "af", "dp", "hit", 7, 1)


_STATES = """(SELECT user_id, event_type AS site, (day(ts) // 7)::BIGINT AS w, CASE WHEN max(value) >= 90 THEN 'fixed' WHEN max(value) > 60 THEN 'minority' WHEN count(*) > 2 THEN 'absent' ELSE 'unread' END AS state FROM events GROUP BY ALL)"""


@query(f"""WITH s AS (SELECT * FROM {_STATES}), m AS (SELECT DISTINCT user_id, w, user_id % 5 = 0 AND w <= 1 AS ex FROM s), b AS (SELECT user_id, min(w) AS t0 FROM m WHERE NOT ex GROUP BY 1 HAVING count(*) >= 2),
s0 AS (SELECT s.user_id, site, state FROM s JOIN b ON s.user_id = b.user_id AND w = t0),
l AS (SELECT s.user_id, s.site, s.w, s.state, coalesce(s0.state, 'unchecked') AS st FROM s JOIN b ON s.user_id = b.user_id AND s.w > t0 LEFT JOIN s0 ON s0.user_id = s.user_id AND s0.site = s.site)
SELECT * FROM (SELECT user_id, site, w, CASE WHEN state = 'fixed' AND st = 'absent' THEN 'new' WHEN state = 'fixed' AND st = 'minority' THEN 'risen' WHEN state = 'fixed' AND st <> 'fixed' THEN 'unknown' WHEN state = 'absent' AND st = 'fixed' THEN 'lost' END AS change FROM l) WHERE change IS NOT NULL""")
def series_gains(t: Tables) -> DataFrame:
    """Users' weeks; the first two weeks of every fifth user can't be a start."""
    g = t.events.groupBy("user_id", F.col("event_type").alias("site"), F.floor(F.day("ts") / 7).alias("w")).agg(F.max("value").alias("v"), F.count(F.lit(1)).alias("dp")).withColumn("sample", F.concat_ws("/", "user_id", "w"))
    samples = g.select(F.col("user_id").alias("group"), "sample", F.col("w").cast("string").alias("time"), F.col("w").cast("double").alias("tnum"), ((F.col("user_id") % 5 == 0) & (F.col("w") <= 1)).alias("excluded")).distinct()
    calls = g.where("v > 60").select("sample", "site", F.when(F.col("v") >= 90, 0.95).otherwise(0.5).alias("af"))
    cells = g.where("v <= 60").select("sample", "site", F.lit(0.0).alias("af"), "dp", F.lit(False).alias("called"))
    return D.series_gains(samples, calls, cells, D.SeriesParams(min_dp=2)).select(F.col("group").alias("user_id"), "site", F.col("time").cast("bigint").alias("w"), "change")


_EFFECTS = "CASE event_type WHEN 'click' THEN 'missense_variant' WHEN 'error' THEN 'stop_gained' ELSE 'synonymous_variant' END"


@query(f"""WITH c AS (SELECT user_id, event_type, (day(ts) // 10)::BIGINT AS w, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY user_id, day(ts) // 10) AS af FROM events GROUP BY user_id, event_type, day(ts) // 10),
s AS (SELECT DISTINCT user_id, w FROM c), g AS (SELECT user_id FROM s GROUP BY 1 HAVING count(*) >= 2), k AS (SELECT DISTINCT user_id, event_type FROM c),
w AS (SELECT s.user_id, k.event_type, s.w, coalesce(c.af, 0.0) AS af FROM s JOIN g USING (user_id) JOIN k USING (user_id) LEFT JOIN c ON c.user_id = s.user_id AND c.w = s.w AND c.event_type = k.event_type),
t AS (SELECT user_id, event_type, list(round(af, 4) ORDER BY w) AS traj, arg_min(af, w) AS f, arg_max(af, w) AS l, max(af) AS hi, min(af) AS lo FROM w GROUP BY ALL),
x AS (SELECT *, f <= 0.10 AND hi >= 0.25 AS e, l >= 0.90 AND f < 0.90 AS x, f >= 0.25 AND l <= 0.10 AS o FROM t WHERE hi - lo >= 0.15),
y AS (SELECT *, list_filter([CASE WHEN e THEN 'emergence' END, CASE WHEN x THEN 'fixation' END, CASE WHEN o THEN 'loss' END, CASE WHEN event_type IN ('click', 'error') THEN 'nonsyn' END, CASE WHEN event_type = 'error' THEN 'high_impact' END], lambda v: v IS NOT NULL) AS flags FROM x)
SELECT user_id, event_type, traj, array_to_string(flags, ',') AS flags, CASE WHEN e AND x THEN 'sweep' WHEN e THEN 'emerge' WHEN o THEN 'lost' WHEN l > f THEN 'rising' WHEN l < f THEN 'declining' ELSE 'stable' END AS label,
  row_number() OVER (PARTITION BY user_id ORDER BY list_max(traj) - list_min(traj) DESC, len(flags) DESC, event_type)::BIGINT AS nth FROM y""")
def dynamics_flags(t: Tables) -> DataFrame:
    """A user's ten-day spans are samples; a kind of event that a span lacks counts as absent there."""
    span = F.floor(F.day("ts") / 10)
    n = t.events.groupBy("user_id", "event_type", span.alias("w")).agg(F.count(F.lit(1)).alias("n"))
    sample = F.concat_ws("/", "user_id", "w")
    calls = D.share_calls(n, F.col("user_id"), sample, F.col("event_type"), "n").drop("group", "depth")
    calls = calls.withColumns({"effect": F.expr(_EFFECTS.replace("event_type", "site")), "impact": F.when(F.col("site") == "error", "HIGH")})
    samples = n.select(F.col("user_id").alias("group"), sample.alias("sample"), F.col("w").alias("time")).distinct()
    return D.trajectories(samples, calls).select(F.col("group").alias("user_id"), F.col("site").alias("event_type"), "traj", F.array_join("flags", ",").alias("flags"), "label", "nth")


def _nation_series(t: Tables) -> DataFrame:
    """Trajectories of nations' shares in the orders of each market segment, month by month."""
    own = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    n = own.groupBy("c_mktsegment", F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.format_string("n%02d", "c_nationkey").alias("site")).agg(F.count(F.lit(1)).alias("n"))
    sample = F.concat_ws("/", "c_mktsegment", "month")
    calls = D.share_calls(n, F.col("c_mktsegment"), sample, F.col("site"), "n", 5.0)
    return D.trajectories(n.select(F.col("c_mktsegment").alias("group"), sample.alias("sample"), F.col("month").alias("time")).distinct(), calls.drop("group"))


@query(f"""WITH n AS (SELECT c_mktsegment AS g, strftime(o_orderdate, '%Y-%m') AS m, printf('n%02d', c_nationkey) AS site, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
c AS (SELECT g, m, site, least(1.0, 5.0 * n / sum(n) OVER (PARTITION BY g, m)) AS af FROM n), w AS (SELECT s.g, s.m, k.site, coalesce(c.af, 0.0) AS af FROM (SELECT DISTINCT g, m FROM n) s JOIN (SELECT DISTINCT g, site FROM n) k USING (g) LEFT JOIN c ON c.g = s.g AND c.m = s.m AND c.site = k.site),
v AS (SELECT g, site FROM w GROUP BY ALL HAVING max(af) - min(af) >= 0.15), x AS (SELECT w.g, w.m, w.site, round(w.af, 4) AS af FROM w JOIN v USING (g, site)),
r AS (SELECT a.g, a.site AS a, b.site AS b, corr(a.af, b.af) AS r FROM x a JOIN x b ON a.g = b.g AND a.m = b.m AND a.site < b.site GROUP BY ALL)
SELECT a, b, {sql_q6('avg(r)')} AS r, count(*) AS n_series, {sql_q6('min(r)')} AS r_min, {sql_q6('max(r)')} AS r_max FROM r GROUP BY a, b""")
def co_dynamics(t: Tables) -> DataFrame:
    each = D.pair_correlations(_nation_series(t), D.EpistasisParams(tile=10))
    means = each.groupBy("a", "b").agg(F.avg("r").alias("m"), F.count(F.lit(1)).alias("n_series"), F.min("r").alias("lo"), F.max("r").alias("hi"))
    return means.select("a", "b", S.q6("m").alias("r"), "n_series", S.q6("lo").alias("r_min"), S.q6("hi").alias("r_max"))


@query()
def epistasis(t: Tables) -> DataFrame:
    return D.epistasis(_nation_series(t), D.EpistasisParams(least_r=0.1, top=None, sites=None, tested=None)).pairs


@query(f"""WITH g AS (SELECT s_suppkey, (s_suppkey * 31 % 900)::BIGINT AS s, (s_suppkey * 31 % 900 + 60)::BIGINT AS e FROM supplier), b AS (SELECT l_partkey // 20 AS bin, count(*) AS n FROM lineitem GROUP BY 1),
o AS (SELECT s_suppkey, s, e, sum(n * (least(e, bin * 20 + 19) - greatest(s, bin * 20) + 1) / 20.0)::DOUBLE AS snps FROM g JOIN b ON s <= bin * 20 + 19 AND bin * 20 <= e GROUP BY ALL)
SELECT s_suppkey, {sql_q6('snps')} AS snps, {sql_q6('1000.0 * snps / (e - s + 1)')} AS per_kb FROM o""")
def hotspot_density(t: Tables) -> DataFrame:
    g = t.supplier.select("s_suppkey", (F.col("s_suppkey") * 31 % 900).alias("s"), (F.col("s_suppkey") * 31 % 900 + 60).alias("e"))
    b = t.lineitem.groupBy(F.floor(F.col("l_partkey") / 20).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    own = I.spread_over_bins(g, "s", "e", 20).join(b, "bin").groupBy("s_suppkey", "s", "e").agg(F.sum(F.col("n") * F.col("share") / F.lit(20.0)).alias("snps"))
    return own.select("s_suppkey", S.q6("snps").alias("snps"), S.q6(1000.0 * F.col("snps") / (F.col("e") - F.col("s") + 1)).alias("per_kb"))


_SPANS = f"(SELECT user_id, event_id, {MINUTE_SQL} AS s, {MINUTE_SQL} + event_id % 240 AS e FROM events)"


def _spans(t: Tables) -> DataFrame:
    m = minute_of_month(F.col("ts"))
    return t.events.select("user_id", "event_id", m.alias("start"), (m + F.col("event_id") % 240).alias("end"))


_MERGED = f"""(SELECT user_id, min(s) AS s, max(e) AS e, count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY s, e, event_id) AS g FROM (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY user_id ORDER BY s, e, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS new FROM {_SPANS})) GROUP BY user_id, g)"""


@query(f"SELECT user_id, s AS start, e AS \"end\", n FROM {_MERGED}")
def merge_intervals(t: Tables) -> DataFrame:
    return I.merge_intervals(_spans(t), ["user_id"])


@query(f"SELECT user_id, sum(e - s + 1)::BIGINT AS covered, {sql_q6('100.0 * sum(e - s + 1) / 43440')} AS pct FROM {_MERGED} GROUP BY 1")
def mask_union_pct(t: Tables) -> DataFrame:
    g = I.merge_intervals(_spans(t), ["user_id"]).groupBy("user_id").agg(F.sum(F.col("end") - F.col("start") + 1).alias("covered"))
    return g.withColumn("pct", S.q6(100.0 * F.col("covered") / 43440))


@query("SELECT user_id, min(d) AS start, max(d) AS \"end\", count(*) AS length FROM (SELECT user_id, d, d - row_number() OVER (PARTITION BY user_id ORDER BY d) AS g FROM (SELECT DISTINCT user_id, day(ts) AS d FROM events)) GROUP BY user_id, g HAVING count(*) >= 2")
def gaps_islands(t: Tables) -> DataFrame:
    return I.gaps_islands(t.events.select("user_id", long(F.day("ts")).alias("d")), ["user_id"], "d", 2)


@query("SELECT user_id, min(d) - 1 AS start, max(d) AS \"end\" FROM (SELECT user_id, d, d - row_number() OVER (PARTITION BY user_id ORDER BY d) AS g FROM (SELECT DISTINCT user_id, day(ts) AS d FROM events)) GROUP BY user_id, g")
def bed_collapse(t: Tables) -> DataFrame:
    return I.to_bed(I.gaps_islands(t.events.select("user_id", long(F.day("ts")).alias("d")), ["user_id"], "d")).select("user_id", "start", "end")


@query(f"""SELECT event_id, last_anchor, coalesce(m - last_anchor >= 600, true) AS masked FROM (SELECT event_id, m, max(CASE WHEN event_type = 'purchase' THEN m END) OVER (PARTITION BY user_id ORDER BY m, event_id ROWS UNBOUNDED PRECEDING) AS last_anchor FROM (SELECT *, {MINUTE_SQL} AS m FROM events))""")
def last_anchor_mask(t: Tables) -> DataFrame:
    e = t.events.select("event_id", "user_id", "event_type", minute_of_month(F.col("ts")).alias("m"))
    return I.last_anchor_mask(e, ["user_id"], ["m", "event_id"], "m", F.col("event_type") == "purchase", 600).select("event_id", "last_anchor", "masked")


@query(f"""WITH c AS (SELECT doc_id, text, length(text) AS n FROM documents)
SELECT doc_id, {sql_q6("CASE WHEN n > 0 THEN 100.0 * (n - length(translate(text, '-N', ''))) / n END")} AS missing, {sql_q6("CASE WHEN n > 0 THEN 100.0 * (n - length(translate(text, 'ACGT', ''))) / n END")} AS callable,
 coalesce(list_max(list_transform(regexp_extract_all(text, '[-N]+'), lambda x: length(x))), 0)::INT AS longest, len(regexp_extract_all(text, '[-N]+'))::INT AS runs FROM c""")
def seq_composition(t: Tables) -> DataFrame:
    from strandwise.operators.variants import composition

    c = t.documents.select("doc_id", composition(F.col("text")).alias("c"))
    return c.select("doc_id", S.q6("c.missing").alias("missing"), S.q6("c.callable").alias("callable"), "c.longest", "c.runs")


@query("""WITH b AS (SELECT p_brand, s_nationkey, count(DISTINCT l_partkey)::DOUBLE / any_value(k) AS breadth FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON p_partkey = l_partkey JOIN (SELECT p_brand AS pb, count(*) AS k FROM part GROUP BY 1) ON pb = p_brand GROUP BY ALL)
SELECT p_brand, count(*) FILTER (breadth < 0.5) AS lost_in, count(*) FILTER (breadth >= 0.9) AS kept_in FROM b GROUP BY 1 HAVING count(*) FILTER (breadth < 0.5) > 0 AND count(*) FILTER (breadth >= 0.6) * 2 >= count(*)""")
def lost_features(t: Tables) -> DataFrame:
    k = t.part.groupBy(F.col("p_brand").alias("pb")).agg(F.count(F.lit(1)).alias("k"))
    both = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(t.part, F.col("p_partkey") == F.col("l_partkey"))
    b = both.groupBy("p_brand", "s_nationkey").agg(F.count_distinct("l_partkey").alias("d")).join(k, F.col("pb") == F.col("p_brand")).withColumn("breadth", F.col("d") / F.col("k"))
    g = b.groupBy("p_brand").agg(F.count_if(F.col("breadth") < 0.5).alias("lost_in"), F.count_if(F.col("breadth") >= 0.9).alias("kept_in"), F.count_if(F.col("breadth") >= 0.6).alias("w"), F.count(F.lit(1)).alias("n"))
    return g.where("lost_in > 0 AND w * 2 >= n").select("p_brand", "lost_in", "kept_in")


@query(f"""WITH r AS (SELECT l_partkey, l_orderkey, l_linenumber, CASE WHEN l_suppkey % 9 > 0 THEN l_suppkey * 7 % 900 END AS a, CASE WHEN l_suppkey % 9 > 0 THEN l_suppkey * 7 % 900 + 25 END AS z, l_quantity AS bf, CASE WHEN l_linenumber < 7 THEN l_linenumber END AS m FROM lineitem),
i AS (SELECT *, row_number() OVER w AS i, max(z) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS was FROM r WINDOW w AS (PARTITION BY l_partkey ORDER BY a NULLS LAST, z NULLS FIRST, bf DESC, m NULLS FIRST, l_orderkey, l_linenumber)),
c AS (SELECT *, sum(CASE WHEN a IS NULL OR was IS NULL OR a > was THEN 1 ELSE 0 END) OVER (PARTITION BY l_partkey ORDER BY i) AS c FROM i),
g AS (SELECT l_partkey, c, max(bf / m) AS worth FROM c GROUP BY ALL), k AS (SELECT *, row_number() OVER w AS rank, lead(worth) OVER w AS next, count(*) OVER (PARTITION BY l_partkey) AS n FROM g WINDOW w AS (PARTITION BY l_partkey ORDER BY worth DESC NULLS LAST, c)),
x AS (SELECT *, max(CASE WHEN rank = 1 THEN worth - next END) OVER (PARTITION BY l_partkey) AS margin FROM k)
SELECT c.l_partkey, l_orderkey, l_linenumber, rank::INT AS donor_rank, n AS n_donors, {sql_q6('margin')} AS margin, CASE WHEN rank = 1 AND margin >= 1 THEN 'resolved' WHEN n = 1 THEN 'only candidate' ELSE 'ambiguous' END AS donor_call FROM c JOIN x ON x.l_partkey = c.l_partkey AND x.c = c.c""")
def rank_donors(t: Tables) -> DataFrame:
    known = F.col("l_suppkey") % 9 > 0
    rows = t.lineitem.select("l_partkey", "l_orderkey", "l_linenumber", F.when(known, F.col("l_suppkey") * 7 % 900).alias("start"), F.when(known, F.col("l_suppkey") * 7 % 900 + 25).alias("end"), "l_quantity", F.when(F.col("l_linenumber") < 7, F.col("l_linenumber")).alias("markers"))
    r = C.rank_donors(rows, ["l_partkey"], ("start", "end"), "l_quantity", "markers", ties=["l_orderkey", "l_linenumber"])
    return r.select("l_partkey", "l_orderkey", "l_linenumber", "donor_rank", "n_donors", S.q6("margin").alias("margin"), "donor_call")


@query("""WITH c AS (SELECT l_partkey, l_suppkey, max(l_quantity) / 10 AS bf, bool_or(l_returnflag = 'A') AS called FROM lineitem GROUP BY ALL), n AS (SELECT l_partkey, count(DISTINCT l_suppkey) AS cohort, count(*) FILTER (called) AS callers FROM c GROUP BY 1)
SELECT c.l_partkey, l_suppkey, CASE WHEN l_suppkey = 13 THEN 'divergent_sample' WHEN cohort >= 5 AND callers::DOUBLE / cohort >= 0.9 THEN 'reference_artifact' WHEN l_suppkey % 17 = 0 THEN 'ambiguous' WHEN NOT called AND bf >= 2 AND callers - called::INT >= 1 THEN 'gene_conversion' WHEN called THEN 'gene_conversion' ELSE 'ambiguous' END AS revised FROM c JOIN n USING (l_partkey)""")
def cohort_revision(t: Tables) -> DataFrame:
    # one exchange by part: aggregations and join follow inside its tasks; a part's suppliers are different by then
    n = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    own = t.lineitem.select("l_partkey", "l_suppkey", "l_quantity", "l_returnflag").repartition(n, "l_partkey")
    c = own.groupBy("l_partkey", "l_suppkey").agg((F.max("l_quantity") / 10).alias("bf"), F.bool_or(F.col("l_returnflag") == "A").alias("called"))
    whole = c.groupBy("l_partkey").agg(F.count("l_suppkey").alias("cohort"), F.count_if("called").alias("callers"))
    both = c.join(whole, "l_partkey").withColumn("v", F.when(F.col("called"), "gene_conversion").otherwise("ambiguous"))
    return C.revise(both, F.col("cohort"), F.col("callers") / F.col("cohort"), F.col("callers") - F.col("called").cast("int"), F.col("v"), F.col("bf"), F.col("l_suppkey") % 17 == 0, F.col("l_suppkey") == 13).select("l_partkey", "l_suppkey", "revised")


@query("""WITH d AS (SELECT l_suppkey AS k, l_partkey % 30 AS pos, count(*) FILTER (l_quantity > CASE WHEN l_suppkey % 5 = 1 AND l_partkey % 30 BETWEEN 10 AND 14 THEN 45 ELSE 25 END) AS acc, count(*) FILTER (l_quantity <= CASE WHEN l_suppkey % 5 = 1 AND l_partkey % 30 BETWEEN 10 AND 14 THEN 45 ELSE 25 END) AS don, l_suppkey % 10 = 1 AND l_partkey % 30 = 12 AS ex FROM lineitem GROUP BY ALL),
l AS (SELECT *, NOT ex AND acc < 5 AND acc + don >= 10 AND acc <= 0.4 * (acc + don) AS lop FROM d), m AS (SELECT k, CASE WHEN count(*) FILTER (NOT ex AND NOT lop) >= 2 THEN median(acc) FILTER (NOT ex AND NOT lop) END AS level FROM l GROUP BY 1 HAVING count(*) FILTER (NOT ex) >= 3),
i AS (SELECT l.*, level, row_number() OVER (PARTITION BY l.k ORDER BY pos) AS i FROM l JOIN m ON m.k = l.k), r AS (SELECT *, i - row_number() OVER (PARTITION BY k ORDER BY pos) AS g FROM i WHERE lop AND (level IS NULL OR acc <= 0.6 * level)),
u AS (SELECT k, g, min(pos) AS s, max(pos) AS e, count(*) AS n, any_value(level)::DOUBLE AS level, median(don)::DOUBLE AS here FROM r GROUP BY k, g HAVING count(*) >= 3),
o AS (SELECT u.*, (SELECT median(don) FROM l WHERE l.k = u.k AND NOT ex AND NOT pos BETWEEN s AND e)::DOUBLE AS other FROM u)
SELECT k AS l_suppkey, s AS start, e AS "end", n, level AS acceptor_level, here AS donor_here, other AS donor_elsewhere FROM o WHERE other > 0 AND here >= 1.25 * other""")
def depleted_runs(t: Tables) -> DataFrame:
    pos = F.col("l_partkey") % 30
    least = F.when((F.col("l_suppkey") % 5 == 1) & pos.between(10, 14), 45).otherwise(25)
    sites = t.lineitem.groupBy("l_suppkey", pos.alias("pos")).agg(F.count_if(F.col("l_quantity") > least).alias("acceptor"), F.count_if(F.col("l_quantity") <= least).alias("donor"))
    return C.depleted_runs(sites.withColumn("called", (F.col("l_suppkey") % 10 == 1) & (F.col("pos") == 12)), ["l_suppkey"], "pos", "acceptor", "donor", "called")


@query("""WITH n AS (SELECT n_name || '/' || c_mktsegment AS sample, l_partkey AS pos, max(l_orderkey) % 6 AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
c AS (SELECT sample, pos, substr('ACGT', b::INT + 1, 1) AS base FROM n WHERE b < 4), v AS (SELECT pos FROM c GROUP BY 1 HAVING count(DISTINCT base) > 1), o AS (SELECT c.* FROM c JOIN v USING (pos))
SELECT x.sample AS a, y.sample AS b, count(*) FILTER (x.base <> y.base) AS snps, count(*) AS compared FROM o x JOIN o y ON x.pos = y.pos AND x.sample < y.sample GROUP BY ALL""")
def sequence_distances(t: Tables) -> DataFrame:
    from strandwise.operators.distances import DistanceParams, plane_distances, planes_of_bases

    own = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 nations by the schema
    bases = own.groupBy(F.concat_ws("/", "n_name", "c_mktsegment").alias("sample"), F.col("l_partkey").alias("pos")).agg((F.max("l_orderkey") % 6).cast("int").alias("b"))
    p = DistanceParams(tile=4096, block=32)
    return plane_distances(planes_of_bases(bases.select("sample", "pos", F.substring(F.lit("ACGTNN"), F.col("b") + 1, F.lit(1)).alias("base")), (), p), (), p)


@query(f"""SELECT l_partkey, {sql_q6('CASE WHEN count(*) FILTER (l_linenumber <= 3) >= 2 THEN avg(l_discount) FILTER (l_linenumber <= 3) END')} AS inside, {sql_q6('CASE WHEN count(*) FILTER (l_linenumber > 3) >= 2 THEN avg(l_discount) FILTER (l_linenumber > 3) END')} AS outside FROM lineitem GROUP BY 1""")
def inside_outside_means(t: Tables) -> DataFrame:
    return C.inside_outside(t.lineitem, ["l_partkey"], F.col("l_linenumber") <= 3, "l_discount").select("l_partkey", S.q6("inside").alias("inside"), S.q6("outside").alias("outside"))


@query("""WITH w AS (SELECT DISTINCT user_id, event_type, day(ts) // 10 AS w FROM events), e AS (SELECT user_id, min(w) AS a, max(w) AS b FROM w GROUP BY 1),
s AS (SELECT user_id, event_type, bool_or(w = a) AS x, bool_or(w = b) AS y FROM w JOIN e USING (user_id) WHERE w = a OR w = b GROUP BY ALL)
SELECT user_id, count(*) FILTER (y AND NOT x)::INT AS acquired, count(*) FILTER (x AND y)::INT AS kept, count(*) FILTER (x AND NOT y)::INT AS lost FROM s GROUP BY 1""")
def acquired_kept_lost(t: Tables) -> DataFrame:
    return C.acquired_kept_lost(t.events.select("user_id", "event_type", F.floor(F.day("ts") / 10).alias("w")), "user_id", "w", "event_type")


@query(f"""SELECT day, {', '.join(f"{sql_q6(f'avg(value) FILTER (event_type = $${e}$$)')} AS {e}_af, count(*) FILTER (event_type = '{e}') AS {e}_dp" for e in ('click', 'purchase'))},
 CASE WHEN count(*) FILTER (event_type = 'purchase') > 0 THEN 'called' ELSE 'unknown' END AS state FROM (SELECT day(ts)::BIGINT AS day, * FROM events) GROUP BY 1""")
def matrix_pivot(t: Tables) -> DataFrame:
    e = t.events.select(long(F.day("ts")).alias("day"), "event_type", "value")
    p = e.groupBy("day").pivot("event_type", ["click", "purchase"]).agg(S.q6(F.avg("value")).alias("af"), F.count(F.lit(1)).alias("dp"))
    return p.fillna(0, ["click_dp", "purchase_dp"]).withColumn("state", F.when(F.col("purchase_dp") > 0, "called").otherwise("unknown"))


@query("""SELECT p_type, p_brand, count(*) FILTER (p_size > 25) AS n_pass, max(length(p_name) - length(p_type))::INT AS indel_len FROM part GROUP BY ALL HAVING count(*) FILTER (p_size > 25) > 0""")
def indel_matrix_having(t: Tables) -> DataFrame:
    g = t.part.groupBy("p_type", "p_brand").agg(F.count_if(F.col("p_size") > 25).alias("n_pass"), F.max(F.length("p_name") - F.length("p_type")).alias("indel_len"))
    return g.where("n_pass > 0")


@query(f"""SELECT event_id, least(a, b) AS start, greatest(a, b) AS "end" FROM (SELECT event_id, {MINUTE_SQL} AS a, json_extract_string(props, '$.k')::BIGINT * 300 AS b FROM events)""")
def interval_scan_normalise(t: Tables) -> DataFrame:
    a, b = minute_of_month(F.col("ts")), long(F.get_json_object("props", "$.k")) * 300
    return t.events.select("event_id", F.least(a, b).alias("start"), F.greatest(a, b).alias("end"))


@query("SELECT event_id, k FROM (SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events) WHERE k % 2 = 1 OR k > 90")
def point_mask_filter(t: Tables) -> DataFrame:
    return t.events.select("event_id", long(F.get_json_object("props", "$.k")).alias("k")).where("k % 2 = 1 OR k > 90")


@query("SELECT n_nationkey, n_regionkey, len, coalesce(sum(len) OVER (PARTITION BY n_regionkey ORDER BY n_nationkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS \"offset\" FROM (SELECT n_nationkey, n_regionkey, length(n_name)::BIGINT * 10 AS len FROM nation)")
def offset_cumsum(t: Tables) -> DataFrame:
    return I.offsets(t.nation.select("n_nationkey", "n_regionkey", (long(F.length("n_name")) * 10).alias("len")), ["n_regionkey"], ["n_nationkey"], "len")


@query(f"""SELECT event_type, count(*) AS n, sum(json_extract_string(props, '$.k')::BIGINT)::BIGINT AS total, {sql_q6("sum(value * json_extract_string(props, '$.k')::BIGINT) / sum(json_extract_string(props, '$.k')::BIGINT)")} AS weighted FROM events GROUP BY 1""")
def nested_json_scan(t: Tables) -> DataFrame:
    k = F.from_json("props", "k bigint")["k"]
    return t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(k).alias("total"), S.q6(F.sum(F.col("value") * k) / F.sum(k)).alias("weighted"))


@query("SELECT p_partkey, coalesce(min(l_quantity) FILTER (l_discount >= 0.09), 65535)::INT AS mul FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY 1")
def sweep_min_collapse(t: Tables) -> DataFrame:
    from strandwise.sources.tracks import collapse_sweep

    sweep = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), F.col("l_quantity").cast("int").alias("k"), (F.col("l_discount") >= 0.09).alias("unique"))
    return collapse_sweep(sweep, t.part.select("p_partkey"), ["p_partkey"])


@query("SELECT c_custkey, 'bal' AS key, CAST(floor(c_acctbal) AS BIGINT)::VARCHAR AS value FROM customer UNION ALL SELECT c_custkey, 'nation', c_nationkey::VARCHAR FROM customer UNION ALL SELECT c_custkey, 'segment', c_mktsegment FROM customer")
def kv_unpivot(t: Tables) -> DataFrame:
    w = t.customer.select("c_custkey", F.floor("c_acctbal").cast("string").alias("bal"), F.col("c_nationkey").cast("string").alias("nation"), F.col("c_mktsegment").alias("segment"))
    return w.unpivot("c_custkey", ["bal", "nation", "segment"], "key", "value")


@query("SELECT c_custkey, c_mktsegment AS segment, c_nationkey::BIGINT AS nation FROM customer")
def kv_pivot(t: Tables) -> DataFrame:
    from strandwise.sources.tables import pivot_kv

    w = t.customer.select("c_custkey", F.col("c_nationkey").cast("string").alias("nation"), F.col("c_mktsegment").alias("segment"))
    wide = pivot_kv(w.unpivot("c_custkey", ["nation", "segment"], "key", "value"), ["c_custkey"], ["segment", "nation"])
    return wide.select("c_custkey", "segment", S.whole(F.col("nation")).alias("nation"))


@query("""SELECT p_partkey, split_part(x, ';', 1) AS a, split_part(x, ';', 2) AS b, TRY_CAST(split_part(x, ';', 3) AS BIGINT) AS size FROM (SELECT p_partkey, p_brand || ';' || p_type || ';' || CASE WHEN p_partkey % 5 = 0 THEN 'NA' ELSE p_size::VARCHAR END AS x, p_size FROM part) WHERE p_size >= 2""")
def packed_path_split(t: Tables) -> DataFrame:
    x = F.split(F.concat_ws(";", "p_brand", "p_type", F.when(F.col("p_partkey") % 5 == 0, "NA").otherwise(F.col("p_size").cast("string"))), ";", 6)
    return t.part.where("p_size >= 2").select("p_partkey", x[0].alias("a"), x[1].alias("b"), S.whole(x[2]).alias("size"))


@query("SELECT day, sample, n FROM (SELECT day(ts)::BIGINT AS day, event_type AS sample, count(*) AS n FROM events WHERE event_type IN ('view', 'click') GROUP BY ALL) WHERE day % 3 = 0")
def sparse_wide_read(t: Tables) -> DataFrame:
    wide = t.events.groupBy(long(F.day("ts")).alias("day")).pivot("event_type", ["click", "error", "purchase", "signup", "view"]).count()
    need = t.spark.range(0, 32, 3).select(F.col("id").alias("day"))
    return wide.select("day", "view", "click").join(need, "day", "left_semi").unpivot("day", ["view", "click"], "sample", "n").where("n IS NOT NULL")


@query("SELECT c_custkey, h || '/' || regexp_replace(b, '(.{2})', '\\1/', 'g') || CASE WHEN length(b) % 2 = 1 THEN '/' ELSE '' END || right(d, 1) AS path FROM (SELECT c_custkey, 'MP' AS h, d, left(d, length(d) - 1) AS b FROM (SELECT c_custkey, regexp_extract(c_name, '([0-9]*)$', 1) AS d FROM customer))")
def nested_path(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", S.nested_path(F.concat(F.lit("MP"), F.regexp_extract("c_name", "([0-9]*)$", 1))).alias("path"))


@query("""WITH o AS (SELECT r_regionkey, r_name, coalesce(sum(n) OVER (ORDER BY r_regionkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off FROM (SELECT r_regionkey, r_name, count(*) * 100 AS n FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY ALL))
SELECT s_suppkey, off + s_suppkey % 100 AS place FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN o ON n_regionkey = r_regionkey""")
def axis_placement(t: Tables) -> DataFrame:
    contigs = t.region.join(t.nation, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_regionkey").agg((F.count(F.lit(1)) * 100).alias("length")).withColumn("genome", F.lit(1))
    off = I.offsets(contigs, ["genome"], ["r_regionkey"], "length")
    s = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return s.join(off, F.col("n_regionkey") == F.col("r_regionkey")).select("s_suppkey", (F.col("offset") + F.col("s_suppkey") % 100).alias("place"))


@query("SELECT pos, listagg(aa || '=S' || l_suppkey || ':' || c, ',' ORDER BY aa, l_suppkey) AS codons FROM (SELECT pos, l_returnflag AS aa, l_suppkey, count(*) AS c FROM (SELECT l_suppkey, l_returnflag, unnest([l_partkey, l_partkey + 1]) AS pos FROM lineitem) GROUP BY ALL) GROUP BY 1")
def codon_attach(t: Tables) -> DataFrame:
    x = t.lineitem.select("l_suppkey", "l_returnflag", F.explode(F.split(F.concat_ws(",", F.col("l_partkey").cast("string"), (F.col("l_partkey") + 1).cast("string")), ",")).alias("p")).withColumn("pos", long("p"))
    g = x.groupBy("pos", F.col("l_returnflag").alias("aa"), "l_suppkey").agg(F.count(F.lit(1)).alias("c"))
    text = F.transform(F.array_sort(F.collect_list(F.struct("aa", "l_suppkey", "c"))), lambda s: F.concat(s["aa"], F.lit("=S"), s["l_suppkey"], F.lit(":"), s["c"]))
    return g.groupBy("pos").agg(F.array_join(text, ",").alias("codons"))


@query("""SELECT k, n, cells FROM (SELECT l_partkey AS k, count(*) AS n, listagg(l_suppkey || ':' || c, ',' ORDER BY l_suppkey) AS cells FROM (SELECT l_partkey, l_suppkey, count(*) AS c FROM lineitem GROUP BY ALL) GROUP BY 1) ORDER BY n DESC, k LIMIT 100""")
def sparse_cells(t: Tables) -> DataFrame:
    c = t.lineitem.groupBy(F.col("l_partkey").alias("k"), "l_suppkey").agg(F.count(F.lit(1)).alias("c"))
    cells = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_suppkey", "c"))), lambda s: F.concat(s["l_suppkey"], F.lit(":"), s["c"])), ",")
    return c.groupBy("k").agg(F.count(F.lit(1)).alias("n"), cells.alias("cells")).orderBy(F.desc("n"), "k").limit(100)


@query("""WITH w AS (SELECT user_id, event_type, day(ts) // 10 AS w, count(*) AS n FROM events GROUP BY ALL), e AS (SELECT user_id, event_type, arg_min(n, w) AS a, arg_max(n, w) AS b FROM w GROUP BY ALL)
SELECT event_type, count(DISTINCT user_id) AS series FROM e WHERE b > a GROUP BY 1 HAVING count(DISTINCT user_id) >= 2""")
def parallel_genes(t: Tables) -> DataFrame:
    w = t.events.groupBy("user_id", "event_type", F.floor(F.day("ts") / 10).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    e = w.groupBy("user_id", "event_type").agg(F.min_by("n", "w").alias("a"), F.max_by("n", "w").alias("b"))
    return e.where("b > a").groupBy("event_type").agg(F.count_distinct("user_id").alias("series")).where("series >= 2")


@query("""WITH u AS (SELECT n_regionkey AS g, unnest(['len', 'first', 'region']) AS f, unnest([length(n_name)::VARCHAR, left(n_name, 1), n_regionkey::VARCHAR]) AS v FROM nation), k AS (SELECT f, g, count(DISTINCT v) AS n, min(v) AS v FROM u GROUP BY ALL)
SELECT f AS field FROM k GROUP BY 1 HAVING max(n) = 1 AND count(DISTINCT v) > 1""")
def invariant_fields(t: Tables) -> DataFrame:
    w = t.nation.select(F.col("n_regionkey").alias("g"), F.length("n_name").cast("string").alias("len"), F.left("n_name", F.lit(1)).alias("first"), F.col("n_regionkey").cast("string").alias("region"))
    k = w.unpivot("g", ["len", "first", "region"], "field", "v").groupBy("field", "g").agg(F.count_distinct("v").alias("n"), F.min("v").alias("v"))
    return k.groupBy("field").agg(F.max("n").alias("m"), F.count_distinct("v").alias("d")).where("m = 1 AND d > 1").select("field")


@query(f"SELECT o_orderpriority, min(year(o_orderdate))::INT AS first, max(year(o_orderdate))::INT AS last, count(*) AS n, {sql_q6('median(o_totalprice)')} AS med FROM orders GROUP BY 1")
def temporal_overview(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderpriority").agg(F.min(F.year("o_orderdate")).alias("first"), F.max(F.year("o_orderdate")).alias("last"), F.count(F.lit(1)).alias("n"), S.q6(F.median("o_totalprice")).alias("med"))


@query(f"SELECT bin, {sql_q6('avg(v)')} AS missing FROM (SELECT user_id, hour(ts)::BIGINT AS bin, count(*) FILTER (value < 10)::DOUBLE / count(*) AS v FROM events GROUP BY ALL) WHERE bin % 8 <> 0 GROUP BY 1 HAVING avg(v) > 0.1")
def bin_lowcall(t: Tables) -> DataFrame:
    p = t.events.groupBy("user_id", long(F.hour("ts")).alias("bin")).agg((F.count_if(F.col("value") < 10) / F.count(F.lit(1))).alias("v"))
    return p.where("bin % 8 <> 0").groupBy("bin").agg(F.avg("v").alias("m")).where("m > 0.1").select("bin", S.q6("m").alias("missing"))


@query("""SELECT CASE WHEN n_nationkey IS NULL THEN 'unknown contig' WHEN o_orderkey % 1000 >= n_nationkey * 40 THEN 'outside' ELSE 'resolved' END AS outcome, count(*) AS n FROM orders LEFT JOIN nation ON n_nationkey = o_custkey % 30 GROUP BY 1""")
def resolve_positions(t: Tables) -> DataFrame:
    both = t.orders.join(F.broadcast(t.nation), F.col("n_nationkey") == F.col("o_custkey") % 30, "left")  # 25 nations by the schema
    outcome = F.when(F.col("n_nationkey").isNull(), "unknown contig").when(F.col("o_orderkey") % 1000 >= F.col("n_nationkey") * 40, "outside").otherwise("resolved")
    return both.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_custkey, sum(CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END)::BIGINT AS expected FROM orders GROUP BY 1")
def expected_counts(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.sum(F.when(F.col("o_orderstatus") == "P", 2).otherwise(1)).alias("expected"))


@query(f"SELECT l_linestatus, {sql_q6('count(*) FILTER (l_returnflag = $$R$$)::DOUBLE / count(*) FILTER (l_returnflag = $$A$$)')} AS ratio, count(*) AS n FROM lineitem GROUP BY 1")
def effect_ratio(t: Tables) -> DataFrame:
    n = lambda f: F.count_if(F.col("l_returnflag") == f)
    return t.lineitem.groupBy("l_linestatus").agg(S.q6(n("R") / F.when(n("A") > 0, n("A"))).alias("ratio"), F.count(F.lit(1)).alias("n"))


@query("SELECT p_partkey, CASE WHEN x IS NULL THEN 'NA' WHEN x > 1 THEN 'positive' WHEN x < 1 THEN 'purifying' ELSE 'neutral' END AS cls FROM (SELECT p_partkey, CASE WHEN p_size % 9 = 0 THEN NULL ELSE p_size / 20.0 END AS x FROM part)")
def dnds_class(t: Tables) -> DataFrame:
    x = F.when(F.col("p_size") % 9 != 0, F.col("p_size") / 20.0)
    return t.part.select("p_partkey", F.when(x.isNull(), "NA").when(x > 1, "positive").when(x < 1, "purifying").otherwise("neutral").alias("cls"))


@query(f"WITH g AS (SELECT user_id, day(ts) AS d, count(*) AS n FROM events GROUP BY ALL), l AS (SELECT user_id, arg_max(n, d) AS n FROM g GROUP BY 1) SELECT user_id % 10 AS grp, {sql_q6('median(n)')} AS med, max(n) AS top FROM l GROUP BY 1")
def last_gain(t: Tables) -> DataFrame:
    g = t.events.groupBy("user_id", F.day("ts").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    last = g.groupBy("user_id").agg(F.max_by("n", "d").alias("n"))
    return last.groupBy((F.col("user_id") % 10).alias("grp")).agg(S.q6(F.median("n")).alias("med"), F.max("n").alias("top"))


@query(f"WITH g AS (SELECT user_id, day(ts)::BIGINT AS d, count(*) AS n FROM events WHERE user_id % 7 <> 0 GROUP BY ALL) SELECT user_id % 10 AS grp, d, {sql_q6('median(n)')} AS gain FROM g GROUP BY ALL")
def gain_per_time(t: Tables) -> DataFrame:
    g = t.events.where("user_id % 7 <> 0").groupBy("user_id", long(F.day("ts")).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    return g.groupBy((F.col("user_id") % 10).alias("grp"), "d").agg(S.q6(F.median("n")).alias("gain"))


@query("SELECT o_orderkey, coalesce(CASE WHEN c_custkey % 3 = 0 THEN c_custkey * 2 END, CASE WHEN s_suppkey IS NOT NULL THEN s_suppkey * 5 END) AS canon, CASE WHEN c_custkey % 3 = 0 OR s_suppkey IS NOT NULL THEN 'placed' ELSE 'absent' END AS state FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN supplier ON s_suppkey = o_orderkey % 300")
def canonical_fill(t: Tables) -> DataFrame:
    a = t.customer.where("c_custkey % 3 = 0").select("c_custkey", (F.col("c_custkey") * 2).alias("v"))
    b = t.supplier.select("s_suppkey", (F.col("s_suppkey") * 5).alias("v"))
    o = t.orders.select("o_orderkey", "o_custkey", (F.col("o_orderkey") % 300).alias("k2"))
    out = R.fallback_join(o, [(a, [("o_custkey", "c_custkey")], "v"), (b, [("k2", "s_suppkey")], "v")], "canon")
    return out.select("o_orderkey", "canon", F.when(F.col("canon").isNotNull(), "placed").otherwise("absent").alias("state"))


@query("SELECT p_partkey, list_filter(string_split(p_type || ' L' || p_size || ' x', ' '), lambda x: regexp_matches(x, '^(L[0-9]|[A-Z]{4})'))[-1] AS finest, string_split(p_type || ' L' || p_size || ' x', ' ')[1] AS top FROM part")
def label_levels(t: Tables) -> DataFrame:
    w = F.split(F.concat(F.col("p_type"), F.lit(" L"), F.col("p_size"), F.lit(" x")), " ")
    return t.part.select("p_partkey", F.element_at(F.filter(w, lambda x: x.rlike("^(L[0-9]|[A-Z]{4})")), -1).alias("finest"), w[0].alias("top"))


@query(f"SELECT h::BIGINT AS bin, CASE WHEN h % 6 = 0 THEN NULL ELSE {sql_q6('avg(n)')} END AS mean FROM (SELECT user_id, hour(ts) AS h, count(*) AS n FROM events GROUP BY ALL) WHERE h BETWEEN 3 AND 20 GROUP BY h")
def track_profile(t: Tables) -> DataFrame:
    g = t.events.groupBy("user_id", long(F.hour("ts")).alias("bin")).agg(F.count(F.lit(1)).alias("n")).where("bin BETWEEN 3 AND 20")
    return g.groupBy("bin").agg(F.avg("n").alias("m")).select("bin", F.when(F.col("bin") % 6 != 0, S.q6("m")).alias("mean"))


@query(f"SELECT c_custkey FROM {_METRICS} WHERE bal BETWEEN 1000 AND 6000 AND mean BETWEEN 100000 AND 300000")
def brush_select(t: Tables) -> DataFrame:
    return _metrics(t).where(F.col("bal").between(1000, 6000) & F.col("mean").between(100000, 300000)).select("c_custkey")


@query("SELECT lang, count(*) FILTER (quality = 1) AS pass, count(*) FILTER (quality = 0) AS below, count(*) FILTER (quality IS NULL) AS no_data FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def auth_tally(t: Tables) -> DataFrame:
    both = t.documents.select("doc_id", "lang").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return both.groupBy("lang").agg(F.count_if(F.col("quality") == 1).alias("pass"), F.count_if(F.col("quality") == 0).alias("below"), F.count_if(F.col("quality").isNull()).alias("no_data"))


@query()
def payload_json(t: Tables) -> DataFrame:
    from strandwise.sources.sinks import payload

    return payload(_verdicts(t).groupBy("verdict").agg(F.count(F.lit(1)).alias("n")), ["verdict"], "n")


@query()
def founder_clusters(t: Tables) -> DataFrame:
    from strandwise.operators.kernels import founder_clusters as run

    spans = t.events.select(F.day("ts").alias("day"), "user_id", minute_of_month(F.col("ts")).alias("start")).withColumn("end", F.col("start") + F.col("user_id") % 240 + 1)
    return run(spans, ["day"], "start", "end", "user_id")


@query()
def lis_chain(t: Tables) -> DataFrame:
    from strandwise.operators.kernels import chains

    return chains(t.lineitem.select("l_suppkey", F.col("l_orderkey").alias("a"), F.col("l_partkey").alias("b")), ["l_suppkey"], "a", "b", least=10)


@query()
def perm_pvalue(t: Tables) -> DataFrame:
    from strandwise.operators.kernels import permutation_p

    w = t.events.groupBy(F.col("user_id").alias("series"), F.day("ts").alias("t")).agg(F.count_if(F.col("event_type") == "view").alias("x"), F.count_if(F.col("event_type") == "click").alias("y"))
    return permutation_p(w.withColumn("pair", F.concat(F.lit("view|click"), F.col("series") % 5)), "pair", "series", "t", "x", "y")


@query()
def affine_align(t: Tables) -> DataFrame:
    from strandwise.operators.kernels import align

    return align(t.part.select("p_partkey", F.col("p_name").alias("a"), F.col("p_type").alias("b")), "p_partkey", "a", "b")


@query()
def bayes_tract(t: Tables) -> DataFrame:
    from strandwise.operators.kernels import conversion_tracts

    donor = F.col("l_linenumber").between(3, 5) & (F.floor(F.col("l_orderkey") / 97) % 3 == 0)
    obs = t.lineitem.select((F.col("l_orderkey") % 97).alias("pair_id"), F.col("l_orderkey").alias("read"), (F.col("l_linenumber") * 100).cast("bigint").alias("pos"), F.when(donor, "D").otherwise("A").alias("allele"), F.lit(30).alias("qual")).distinct()
    return conversion_tracts(obs, ["pair_id"])




_MIXED_FLAGS = """list_filter([CASE WHEN n < CASE WHEN old THEN 3 ELSE 10 END THEN 'LOW_DEPTH' END, CASE WHEN bal < CASE WHEN old THEN 30 ELSE 90 END THEN 'LOW_BREADTH' END, CASE WHEN hi > CASE WHEN old THEN 60 ELSE 4 END THEN 'HIGH_DUP' END,
  CASE WHEN old THEN NULL WHEN mean > 180000 THEN 'SNP_HIGH' WHEN mean < 120000 THEN 'SNP_LOW' END, CASE WHEN NOT old AND hi + n >= 5 AND 100.0 * hi / (hi + n) > 3 THEN 'HET_HIGH' END, CASE WHEN old AND bal / 10000 < 0.05 THEN 'DAMAGE_LOW' END], lambda x: x IS NOT NULL)"""


@query(f"SELECT c_custkey, array_to_string(f, ';') AS flags, CASE WHEN list_has_any(f, ['NO_DATA', 'LOW_DEPTH', 'LOW_BREADTH', 'HIGH_MISSING']) THEN 'FAIL' WHEN len(f) > 0 THEN 'WARN' ELSE 'PASS' END AS verdict FROM (SELECT c_custkey, {_MIXED_FLAGS} AS f FROM (SELECT *, c_custkey % 3 = 0 AS old FROM {_METRICS}))")
def qc_verdict_ancient(t: Tables) -> DataFrame:
    c = {"depth": F.col("n"), "breadth": F.col("bal"), "dup": F.col("hi"), "snp_z": (F.col("mean") - 150000) / 10000, "het": F.col("hi"), "hom": F.col("n"), "damage": F.col("bal") / 10000, "ancient": F.col("c_custkey") % 3 == 0}
    own = _metrics(t).select("c_custkey", C.qc_flags(c, C.QcThresholds(dup=4, het_least=5)).alias("f"))
    return own.select("c_custkey", F.array_join("f", ";").alias("flags"), C.verdict(F.col("f")).alias("verdict"))


@query("""WITH g AS (SELECT c_mktsegment AS s, n_regionkey AS r, n_nationkey AS n, count(*) AS k FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
r AS (SELECT s, r, sum(k)::BIGINT AS k, row_number() OVER (PARTITION BY s ORDER BY sum(k) DESC, r) AS i FROM g GROUP BY s, r), n AS (SELECT *, row_number() OVER (PARTITION BY s, r ORDER BY k DESC, n) AS i FROM g),
d AS (SELECT r.s, r.i, CASE WHEN n.k >= 0.21 * r.k THEN 100 + n.n ELSE 10 + r.r END::BIGINT AS taxid, CASE WHEN n.k >= 0.21 * r.k THEN n.k ELSE r.k END AS reads FROM r JOIN n ON r.s = n.s AND r.r = n.r AND n.i = 1),
v AS (SELECT taxid FROM d WHERE i = 1 GROUP BY 1 ORDER BY count(*) DESC, sum(reads) DESC, taxid LIMIT 1), c AS (SELECT s, 10 + r AS taxid, k FROM r UNION ALL SELECT s, 100 + n, k FROM g), w AS (SELECT s, sum(k) AS k FROM g GROUP BY 1)
SELECT a.s AS c_mktsegment, a.taxid AS "primary", a.reads, b.taxid AS secondary, round(100.0 * coalesce((SELECT k FROM c WHERE c.s = a.s AND c.taxid = (SELECT taxid FROM v)), 0) / w.k, 2)::DOUBLE AS target_pct FROM d a JOIN d b ON a.s = b.s AND b.i = 2 JOIN w ON w.s = a.s WHERE a.i = 1""")
def dominant_clade(t: Tables) -> DataFrame:
    from strandwise.operators import taxonomy as X

    both = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 nations by the schema
    levels = both.groupBy(F.col("c_mktsegment").alias("sample"), "n_regionkey", "n_nationkey").agg(F.count(F.lit(1)).alias("clade_reads"))
    node = lambda keys, taxid, parent, rank: levels.groupBy("sample", *keys).agg(F.sum("clade_reads").alias("clade_reads")).select("sample", long(taxid).alias("taxid"), parent.cast("bigint").alias("parent"), "clade_reads", F.lit(rank).alias("rank"))
    region = F.col("n_regionkey") + 10
    tree = node([], F.lit(1), F.lit(None), "R").union(node(["n_regionkey"], region, F.lit(1), "D")).union(node(["n_regionkey", "n_nationkey"], F.col("n_nationkey") + 100, region, "G"))
    tree = X.merge_runs(tree.select("*", F.lit(0).alias("reads"), F.lit("report").alias("file"), F.col("taxid").alias("line"), F.col("taxid").cast("string").alias("name")))
    clades = X.dominant_clade(tree, share=0.21)
    share = X.target_share(clades, tree, X.target_vote(clades))
    return clades.join(share, "sample").select(F.col("sample").alias("c_mktsegment"), F.col("primary.taxid").alias("primary"), F.col("primary.reads").alias("reads"), F.col("secondary.taxid").alias("secondary"), "target_pct")
