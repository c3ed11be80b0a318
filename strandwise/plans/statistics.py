"""Queries on robust statistics, ranks, tests, histograms and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.functions import genomics as G
from strandwise.functions import scalars as S
from strandwise.operators import matrix as M
from strandwise.operators import stats as ST
from strandwise.operators.ordered import joined, upper_medians
from strandwise.plans.base import Tables, long, query, sql_q6


@query(f"""WITH m AS (SELECT event_type, median(value) AS med, stddev_pop(value) AS sd FROM events GROUP BY 1),
s AS (SELECT event_type, med, CASE WHEN median(abs(value - med)) > 0 THEN 1.4826 * median(abs(value - med)) WHEN any_value(sd) > 0 THEN any_value(sd) ELSE 1.0 END AS sigma FROM events JOIN m USING (event_type) GROUP BY ALL)
SELECT event_id, event_type, {sql_q6('(value - med) / sigma')} AS z, CASE WHEN abs((value - med) / sigma) > 3 THEN 'FAIL' WHEN abs((value - med) / sigma) > 2 THEN 'WARN' ELSE 'PASS' END AS verdict FROM events JOIN s USING (event_type)""")
def robust_outlier(t: Tables) -> DataFrame:
    z = ST.robust_z(t.events.select("event_id", "event_type", "value"), ["event_type"], "value")
    v = F.when(F.abs("z") > 3, "FAIL").when(F.abs("z") > 2, "WARN").otherwise("PASS")
    return z.select("event_id", "event_type", S.q6("z").alias("z"), v.alias("verdict"))


@query(f"""WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS q2, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1)
SELECT l_returnflag, {sql_q6('q1')} AS q1, {sql_q6('q2')} AS q2, {sql_q6('q3')} AS q3, {sql_q6('q1 - 1.5 * (q3 - q1)')} AS low, {sql_q6('q3 + 1.5 * (q3 - q1)')} AS high, {sql_q6('(q3 + q1 - 2 * q2) / (q3 - q1)')} AS bowley FROM q""")
def quantiles_fences(t: Tables) -> DataFrame:
    f = ST.fences(t.lineitem, ["l_returnflag"], "l_extendedprice")
    return f.select("l_returnflag", *[S.q6(c).alias(c) for c in ("q1", "q2", "q3", "low", "high", "bowley")])


@query(f"""WITH r AS (SELECT l_returnflag, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2.0 AS a,
  rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_returnflag, l_extendedprice) - 1) / 2.0 AS b FROM lineitem)
SELECT l_returnflag, {sql_q6('corr(a, b)')} AS rho, count(*) AS n FROM r GROUP BY 1""")
def rank_avg_spearman(t: Tables) -> DataFrame:
    s = ST.spearman(t.lineitem, ["l_returnflag"], "l_quantity", "l_extendedprice")
    return s.select("l_returnflag", S.q6("rho").alias("rho"), "n")


@query(f"""WITH p AS (SELECT l_suppkey, avg(l_discount) * 10 AS p FROM lineitem GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY p, l_suppkey) AS k, count(*) OVER () AS m FROM p)
SELECT l_suppkey, {sql_q6('least(1.0, min(p * m / k) OVER (ORDER BY k DESC ROWS UNBOUNDED PRECEDING))')} AS q FROM r""")
def bh_fdr(t: Tables) -> DataFrame:
    p = t.lineitem.groupBy("l_suppkey").agg((F.avg("l_discount") * 10).alias("p")).withColumn("family", F.lit(1))
    return ST.bh_fdr(p, ["family"], "p", ["l_suppkey"]).select("l_suppkey", S.q6("q").alias("q"))


@query(f"""SELECT l_suppkey, {sql_q6('CASE WHEN count(*) >= 3 THEN corr(l_quantity, l_extendedprice) END')} AS r, count(*) AS n FROM lineitem GROUP BY 1""")
def pearson_pairs(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_suppkey").agg(S.q6(ST.pearson("l_quantity", "l_extendedprice")).alias("r"), F.count(F.lit(1)).alias("n"))


@query(f"""WITH r AS (SELECT l_linestatus AS k, l_returnflag AS g, l_quantity AS v, rank() OVER (PARTITION BY l_linestatus ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_linestatus, l_quantity) - 1) / 2.0 AS r FROM lineitem),
q AS (SELECT k, sum(s * s / n) AS q, sum(n)::DOUBLE AS n, count(*) - 1 AS df FROM (SELECT k, g, sum(r) AS s, count(*) AS n FROM r GROUP BY ALL) GROUP BY k),
ti AS (SELECT k, sum(t::DOUBLE * t * t - t) AS ties FROM (SELECT k, v, count(*) AS t FROM r GROUP BY ALL) GROUP BY k)
SELECT k AS l_linestatus, {sql_q6('(12 / (n * (n + 1)) * q - 3 * (n + 1)) / (1 - ties / (n * n * n - n))')} AS h, df FROM q JOIN ti USING (k)""")
def kruskal_h(t: Tables) -> DataFrame:
    return ST.kruskal_h(t.lineitem, ["l_linestatus"], "l_returnflag", "l_quantity").select("l_linestatus", S.q6("h").alias("h"), "df")


@query(f"""WITH w AS (SELECT user_id, day(ts) AS x, count(*) FILTER (event_type = 'purchase')::DOUBLE / count(*) AS f FROM events GROUP BY ALL)
SELECT user_id, {sql_q6('regr_slope(y, x)')} AS slope, {sql_q6('regr_r2(y, x)')} AS r2 FROM (SELECT user_id, x, ln(greatest(0.02, least(0.98, f)) / (1 - greatest(0.02, least(0.98, f)))) AS y FROM w) GROUP BY 1""")
def ols_logit(t: Tables) -> DataFrame:
    w = t.events.groupBy("user_id", F.day("ts").alias("x")).agg((F.count_if(F.col("event_type") == "purchase") / F.count(F.lit(1))).alias("f"))
    slope, r2 = ST.ols(F.col("x"), F.col("y"))
    return w.withColumn("y", ST.logit(F.col("f"))).groupBy("user_id").agg(S.q6(slope).alias("slope"), S.q6(r2).alias("r2"))


@query(f"""WITH v AS (SELECT p_brand, l_partkey, p_retailprice AS dose, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) / sum(l_quantity) AS af FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL),
c AS (SELECT p_brand FROM v GROUP BY 1 HAVING count(*) >= 6 AND count(*) FILTER (af > 0) >= 3),
r AS (SELECT p_brand, rank() OVER (PARTITION BY p_brand ORDER BY dose) + (count(*) OVER (PARTITION BY p_brand, dose) - 1) / 2.0 AS a, rank() OVER (PARTITION BY p_brand ORDER BY af) + (count(*) OVER (PARTITION BY p_brand, af) - 1) / 2.0 AS b FROM v WHERE p_brand IN (SELECT p_brand FROM c))
SELECT p_brand, {sql_q6('corr(a, b)')} AS rho, count(*) AS n FROM r GROUP BY 1""")
def variant_dose_scan(t: Tables) -> DataFrame:
    both = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey"))
    v = both.groupBy("p_brand", "l_partkey", F.col("p_retailprice").alias("dose")).agg((F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0)) / F.sum("l_quantity")).alias("af"))
    return ST.dose_scan(v, ["p_brand"], "dose", "af").select("p_brand", S.q6("rho").alias("rho"), "n")


@query()
def zscore_matrix(t: Tables) -> DataFrame:
    c = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).cast("double").alias("orders"), F.avg("o_totalprice").alias("mean"), F.max("o_totalprice").alias("top"))
    own = t.customer.select("c_custkey", F.col("c_acctbal").alias("bal")).join(c, "c_custkey")
    return M.principal_axes(own, "c_custkey", ["bal", "orders", "mean", "top"])


@query()
def mahalanobis(t: Tables) -> DataFrame:
    own = t.lineitem.groupBy("l_suppkey").agg(F.avg("l_quantity").alias("q"), F.avg("l_discount").alias("d"), F.avg("l_tax").alias("x"))
    return M.mahalanobis(own, "l_suppkey", ["q", "d", "x"])


@query(f"""SELECT l_returnflag, {sql_q6('(sx + sy) / 2 + sqrt(((sx - sy) / 2) * ((sx - sy) / 2) + c * c)')} AS major, {sql_q6('(sx + sy) / 2 - sqrt(((sx - sy) / 2) * ((sx - sy) / 2) + c * c)')} AS minor, {sql_q6('atan2(2 * c, sx - sy) / 2')} AS angle
FROM (SELECT l_returnflag, var_samp(l_quantity) AS sx, var_samp(l_discount * 100) AS sy, covar_samp(l_quantity, l_discount * 100) AS c FROM lineitem GROUP BY 1)""")
def ellipse_cov(t: Tables) -> DataFrame:
    e = M.ellipse(t.lineitem.withColumn("d", F.col("l_discount") * 100), ["l_returnflag"], "l_quantity", "d")
    return e.select("l_returnflag", *[S.q6(c).alias(c) for c in ("major", "minor", "angle")])


@query(f"""WITH m AS (SELECT l_suppkey AS k, unnest(['quantity', 'price', 'discount', 'tax']) AS metric, unnest([avg(l_quantity), avg(l_extendedprice), avg(l_discount), avg(l_tax)]) AS v FROM lineitem GROUP BY 1)
SELECT a.metric AS a, b.metric AS b, {sql_q6('corr(a.v, b.v)')} AS r FROM m a JOIN m b ON a.k = b.k AND a.metric < b.metric WHERE NOT (a.metric = 'price' AND b.metric = 'quantity') GROUP BY ALL""")
def strongest_pairs(t: Tables) -> DataFrame:
    m = t.lineitem.groupBy("l_suppkey").agg(F.avg("l_quantity").alias("quantity"), F.avg("l_extendedprice").alias("price"), F.avg("l_discount").alias("discount"), F.avg("l_tax").alias("tax"))
    return M.metric_pairs(m, "l_suppkey", ["quantity", "price", "discount", "tax"], [("price", "quantity")]).select("a", "b", S.q6("r").alias("r"))


@query("""WITH r AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi, least(30, greatest(8, round_even(sqrt(count(*)), 0)))::BIGINT AS nb FROM customer)
SELECT least(nb - 1, floor((c_acctbal - lo) / (hi - lo) * nb)::BIGINT) AS bin, count(*) AS n FROM customer, r GROUP BY 1""")
def histogram_sqrt_bins(t: Tables) -> DataFrame:
    return M.sqrt_histogram(t.customer, "c_acctbal")


@query(f"""WITH m AS (SELECT o_custkey AS k, count(*) AS a, avg(o_totalprice) AS b FROM orders GROUP BY 1), r AS (SELECT rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0 AS x, rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2.0 AS y FROM m)
SELECT {sql_q6('corr(x, y)')} AS rho, count(*) AS n FROM r""")
def metric_pair_readout(t: Tables) -> DataFrame:
    m = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("a"), F.avg("o_totalprice").alias("b")).withColumn("view", F.lit(1))
    return ST.spearman(m, ["view"], "a", "b").select(S.q6("rho").alias("rho"), "n")


@query(f"SELECT c_custkey, {sql_q6('(rank() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal) - 1)::DOUBLE / count(*) OVER (PARTITION BY c_mktsegment)')} AS below FROM customer")
def pct_rank(t: Tables) -> DataFrame:
    return ST.share_below(t.customer, ["c_mktsegment"], "c_acctbal", "below").select("c_custkey", S.q6("below").alias("below"))


@query("""WITH d AS (SELECT (abs(a.s_suppkey * 37 - b.s_suppkey * 11) % 40)::BIGINT AS d FROM supplier a JOIN supplier b ON a.s_suppkey < b.s_suppkey AND a.s_nationkey = b.s_nationkey)
SELECT CASE WHEN d < 5 THEN 0 WHEN d < 10 THEN 1 WHEN d < 12 THEN 2 WHEN d < 20 THEN 3 ELSE 4 END AS bin, count(*) AS n FROM d GROUP BY 1""")
def edge_histogram(t: Tables) -> DataFrame:
    s, o = t.supplier.select("s_suppkey", "s_nationkey"), t.supplier.select(F.col("s_suppkey").alias("b"), "s_nationkey")
    d = s.join(o, "s_nationkey").where("s_suppkey < b").select(long(F.abs(F.col("s_suppkey") * 37 - F.col("b") * 11) % 40).alias("d"))
    return M.edge_histogram(d, "d", [5, 10, 20], extra=12)


@query("""WITH v AS (SELECT l_suppkey, count(*) FILTER (l_returnflag = 'R')::DOUBLE AS v FROM lineitem GROUP BY 1), m AS (SELECT median(v) AS med FROM v)
SELECT l_suppkey, CASE WHEN v >= greatest(2, 4 * med) THEN 'severe' ELSE 'elevated' END AS level FROM v, m WHERE v >= greatest(1, 2 * med) OR v >= greatest(1, 1.05 * med)""")
def elevated_screen(t: Tables) -> DataFrame:
    v = t.lineitem.groupBy("l_suppkey").agg(F.count_if(F.col("l_returnflag") == "R").cast("double").alias("v"))
    return ST.elevated(v, "v", factor=1.05).select("l_suppkey", "level")


@query(f"SELECT l_orderkey, {sql_q6('max(l_discount * 10) + ln(sum(exp(l_discount * 10 - m)) / exp(max(l_discount * 10) - any_value(m)))')} AS lse FROM (SELECT *, max(l_discount * 10) OVER (PARTITION BY l_orderkey) AS m FROM lineitem) GROUP BY 1")
def logsumexp(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.col("l_discount") * 10)).alias("v")).select("l_orderkey", S.q6(S.logsumexp(F.col("v"))).alias("lse"))


@query("""SELECT o_orderkey, (date_diff('day', DATE '0001-01-01', o_orderdate::DATE) + 1)::DOUBLE AS ordinal FROM orders""")
def date_parse(t: Tables) -> DataFrame:
    d = F.to_date("o_orderdate")
    text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format(d, "yyyy-MM-dd")).when(F.day(d) > 12, F.date_format(d, "MM/dd/yyyy")).otherwise(F.date_format(d, "dd/MM/yyyy"))
    return t.orders.select("o_orderkey", S.parse_date_ordinal(text).alias("ordinal"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 0.0 WHEN c_custkey % 4 = 1 THEN (c_custkey % 50)::DOUBLE WHEN c_custkey % 4 = 2 THEN NULL ELSE -1.5 END AS at FROM customer""")
def date_heuristics(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    text = F.when(k % 4 == 0, F.lit(" Baseline ")).when(k % 4 == 1, F.concat(F.lit("week "), (k % 50).cast("string"))).when(k % 4 == 2, F.lit("unknown")).otherwise(F.lit("day -1.5"))
    return t.customer.select("c_custkey", S.parse_date_ordinal(text).alias("at"))


@query(r"""SELECT page_id, regexp_replace(url, '[^A-Za-z0-9_.-]+', '_', 'g') AS safe, regexp_replace(regexp_extract(url || '/run_1.fastq.gz', '([^/]*)$', 1), '\.(fastq|fq)(\.(gz|bz2))?$', '') AS run,
  CASE WHEN trim(split_part(url, '/', 4)) IN ('', 'NA', '.') THEN NULL ELSE trim(split_part(url, '/', 4)) END AS part, reverse(translate(upper(left(url, 8)), 'ACGT', 'TGCA')) AS rc FROM pages""")
def string_scalars(t: Tables) -> DataFrame:
    u = F.col("url")
    return t.pages.select("page_id", S.sanitize_id(u).alias("safe"), S.infer_run_id(F.concat(u, F.lit("/run_1.fastq.gz"))).alias("run"), S.nullif_in(F.split_part(u, F.lit("/"), F.lit(4)), ["", "NA", "."]).alias("part"), G.revcomp(F.upper(F.left(u, F.lit(8)))).alias("rc"))


@query("""SELECT p_partkey, (['I', 'M', 'W', '*'])[(p_partkey % 4)::INT + 1] || p_size || (['K', '*', 'G'])[(p_partkey % 3)::INT + 1] AS short, p_partkey % 3 = 1 OR p_partkey % 4 = 3 AS lof FROM part""")
def hgvs_short(t: Tables) -> DataFrame:
    pick = lambda names, m: F.element_at(F.array(*map(F.lit, names)), (F.col("p_partkey") % m).cast("int") + 1)
    h = F.concat(F.lit("p."), pick(("Ile", "Met", "Trp", "Ter"), 4), F.col("p_size").cast("string"), pick(("Lys", "*", "Gly"), 3))
    return t.part.select("p_partkey", G.hgvs_short(h).alias("short"), G.is_lof(h).alias("lof"))


@query("SELECT l_orderkey, list_sum(list_transform(list_sort(list(l_linenumber)), lambda x: x * x))::BIGINT AS squares, list_sort(list(DISTINCT l_returnflag)) AS flags, (list_sort(list(l_partkey)))[1] AS first FROM lineitem GROUP BY 1")
def array_map_scalars(t: Tables) -> DataFrame:
    g = t.lineitem.groupBy("l_orderkey").agg(F.collect_list("l_linenumber").alias("n"), F.collect_set("l_returnflag").alias("f"), F.min("l_partkey").alias("first"))
    return g.select("l_orderkey", F.aggregate(F.transform("n", lambda x: (x * x).cast("bigint")), F.lit(0).cast("bigint"), lambda a, x: a + x).alias("squares"), F.array_sort("f").alias("flags"), "first")


@query("""SELECT vec_id, len(list_filter(embedding, lambda x: x > 0))::BIGINT AS positive, ((list_sort(embedding))[1])::DOUBLE AS least, len(embedding[3:10])::BIGINT AS cut FROM embeddings""")
def array_fold(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", long(F.size(F.filter("embedding", lambda x: x > 0))).alias("positive"), F.array_min("embedding").cast("double").alias("least"), long(F.size(F.slice("embedding", 3, 8))).alias("cut"))


@query(f"SELECT c_mktsegment, {sql_q6('(list_sort(list(c_acctbal)))[count(*) // 2 + 1]')} AS upper_median, count(*) AS n, {sql_q6('100.0 * count(*) FILTER (c_acctbal > 0) / count(*)')} AS pct FROM customer GROUP BY 1")
def group_summary_upper_median(t: Tables) -> DataFrame:
    g = t.customer.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), S.q6(100.0 * F.count_if(F.col("c_acctbal") > 0) / F.count(F.lit(1))).alias("pct"))
    return joined(g, upper_medians(t.customer, ["c_mktsegment"], "c_acctbal", "m"), ["c_mktsegment"]).select("c_mktsegment", S.q6("m").alias("upper_median"), "n", "pct")


@query(f"SELECT l_orderkey, {sql_q6('sum(l_tax * l_quantity) / sum(l_quantity)')} AS tax, {sql_q6('CASE WHEN sum(CASE WHEN l_linenumber > 2 THEN l_quantity ELSE 0 END) > 0 THEN sum(l_discount * CASE WHEN l_linenumber > 2 THEN l_quantity ELSE 0 END) / sum(CASE WHEN l_linenumber > 2 THEN l_quantity ELSE 0 END) ELSE avg(l_discount) END')} AS discount FROM lineitem GROUP BY 1")
def lane_weighted_mean(t: Tables) -> DataFrame:
    w = F.when(F.col("l_linenumber") > 2, F.col("l_quantity")).otherwise(0.0)
    return t.lineitem.groupBy("l_orderkey").agg(S.q6(ST.weighted_mean(F.col("l_tax"), F.col("l_quantity"))).alias("tax"), S.q6(ST.weighted_mean(F.col("l_discount"), w)).alias("discount"))


@query("SELECT lang, n_words, n FROM (SELECT lang, (n_chars // 100)::BIGINT AS n_words, count(*) AS n, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, n_chars // 100) AS k FROM documents GROUP BY lang, n_chars // 100) WHERE k = 1")
def modal_length(t: Tables) -> DataFrame:
    return ST.mode_with_tie(t.documents.withColumn("n_words", F.floor(F.col("n_chars") / 100)), ["lang"], "n_words").select("lang", "n_words", "n")


@query("SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'off' WHEN c_acctbal < 3000 THEN 'mixed' WHEN c_custkey % 10 > 7 THEN 'many-unclassified' ELSE 'pure' END AS state FROM customer")
def band_states(t: Tables) -> DataFrame:
    from strandwise.operators.cohort import purity_state

    return t.customer.select("c_custkey", purity_state(F.col("c_acctbal"), F.col("c_custkey") % 10, off=0, mixed=3000, unclassified=7).alias("state"))


@query(f"SELECT {sql_q6('median(value)')} AS med, {sql_q6('avg(value)')} AS mean, {sql_q6('count(*) FILTER (value < 1)::DOUBLE / count(*)')} AS zero, {sql_q6('count(*) FILTER (value >= 30)::DOUBLE / count(*)')} AS callable FROM events")
def global_summary(t: Tables) -> DataFrame:
    from strandwise.operators.cohort import depth_summary

    return depth_summary(t.events, [], F.col("value"), callable_at=30, zero_below=1).select(*[S.q6(c).alias(c) for c in ("med", "mean", "zero", "callable")])


@query(f"SELECT user_id, CASE WHEN count(*) >= 50 THEN {sql_q6('count(*) FILTER (event_type = $$error$$)::DOUBLE / count(*)')} END AS het FROM events WHERE event_type IN ('error', 'view', 'click') GROUP BY 1")
def guarded_ratio(t: Tables) -> DataFrame:
    from strandwise.operators.cohort import guarded_fraction

    e = t.events.where("event_type IN ('error', 'view', 'click')").groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("a"), F.count_if(F.col("event_type") != "error").alias("b"))
    return e.select("user_id", S.q6(guarded_fraction(F.col("a"), F.col("b"), 50)).alias("het"))


@query(f"""SELECT l_suppkey, {sql_q6("100.0 * count(*) FILTER (l_returnflag IN ('R', 'A')) / count(*)")} AS coding, {sql_q6("CASE WHEN count(*) FILTER (l_returnflag IN ('R', 'A')) > 0 THEN 100.0 * count(*) FILTER (l_returnflag = 'R') / count(*) FILTER (l_returnflag IN ('R', 'A')) END")} AS lof FROM lineitem GROUP BY 1""")
def derived_pct(t: Tables) -> DataFrame:
    from strandwise.operators.cohort import percent

    c = lambda *f: F.count_if(F.col("l_returnflag").isin(*f))
    g = t.lineitem.groupBy("l_suppkey").agg(c("R").alias("r"), c("R", "A").alias("ra"), F.count(F.lit(1)).alias("n"))
    return g.select("l_suppkey", S.q6(percent(F.col("ra"), F.col("n"))).alias("coding"), S.q6(percent(F.col("r"), F.col("ra"))).alias("lof"))


@query("SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers, count(*) AS n FROM lineitem GROUP BY 1")
def distinct_aggregates(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers"), F.count(F.lit(1)).alias("n"))


@query("""SELECT CASE WHEN n = 1 THEN 'singleton' ELSE 'shared' END AS kind, count(*) AS pairs, max(n) AS most FROM (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY 1""")
def occupancy(t: Tables) -> DataFrame:
    g = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    return g.groupBy(F.when(F.col("n") == 1, "singleton").otherwise("shared").alias("kind")).agg(F.count(F.lit(1)).alias("pairs"), F.max("n").alias("most"))


@query(f"""WITH w AS (SELECT event_type, value, exp(-abs(value - 50) / 10) AS wt, event_id FROM events), s AS (SELECT *, wt / sum(wt) OVER (PARTITION BY event_type) AS share FROM w),
c AS (SELECT *, sum(share) OVER (PARTITION BY event_type ORDER BY share DESC, event_id ROWS UNBOUNDED PRECEDING) - share AS before FROM s)
SELECT event_type, {sql_q6('min(value)')} AS low, {sql_q6('max(value)')} AS high FROM c WHERE before < 0.95 GROUP BY 1""")
def credible_interval(t: Tables) -> DataFrame:
    w = t.events.withColumn("wt", F.exp(-F.abs(F.col("value") - 50) / 10))
    return ST.highest_density(w, ["event_type"], "value", "wt", ["event_id"], 0.95).select("event_type", S.q6("low").alias("low"), S.q6("high").alias("high"))


@query("SELECT k, bin, count(*) AS n FROM (SELECT l_returnflag AS k, (day(l_shipdate) * 24 // 7)::BIGINT AS bin FROM lineitem) GROUP BY ALL")
def pos_windows(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(F.col("l_returnflag").alias("k"), F.floor(F.day("l_shipdate") * 24 / 7).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


