"""Queries that put the driver tables in the roles of variant calls, annotations and reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.functions import genomics as G
from strandwise.functions import scalars as S
from strandwise.operators import intervals as I
from strandwise.operators import variants as V
from strandwise.plans.base import MINUTE_SQL, Tables, long, minute_of_month, query, sql_q6

_CALLS = """(SELECT l_orderkey, l_linenumber, l_quantity AS dp, least(1.0, l_discount * 10) AS af,
  l_linenumber::INT AS saf, (l_partkey % 5)::INT AS sar,
  floor(l_quantity * least(1.0, l_discount * 10) + 0.5)::BIGINT AS ao,
  (l_quantity::BIGINT - floor(l_quantity * least(1.0, l_discount * 10) + 0.5)::BIGINT) AS ro FROM lineitem)"""


def _calls(t: Tables) -> DataFrame:
    af = F.least(F.lit(1.0), F.col("l_discount") * 10)
    ao = long(F.floor(F.col("l_quantity") * af + 0.5))
    return t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("dp"), af.alias("af"), F.col("l_linenumber").alias("saf"), (F.col("l_partkey") % 5).cast("int").alias("sar"), ao.alias("ao"), (long("l_quantity") - ao).alias("ro"))


@query(f"""SELECT l_orderkey, l_linenumber,
  CASE WHEN base AND ao::DOUBLE / (ao + ro) >= 0.9 THEN 'hom' WHEN base AND ao::DOUBLE / (ao + ro) >= 0.1 THEN 'het' ELSE 'none' END AS call,
  CASE WHEN base AND ao::DOUBLE / (ao + ro) >= 0.1 THEN 'PASS' ELSE 'LowSupport' END AS soft
FROM (SELECT *, dp >= 30 AND saf >= 2 AND sar >= 2 AND ao + ro > 0 AS base FROM {_CALLS})""")
def call_rule_hom_het(t: Tables) -> DataFrame:
    rule = lambda kind: G.call_rule(kind, F.col("dp"), F.lit(None).cast("double"), F.col("saf"), F.col("sar"), F.col("ao"), F.col("ro"))
    return _calls(t).select(
        "l_orderkey",
        "l_linenumber",
        F.when(rule("hom"), "hom").when(rule("het"), "het").otherwise("none").alias("call"),
        F.when(rule("either"), "PASS").otherwise("LowSupport").alias("soft"),
    )


@query(f"SELECT DISTINCT l_orderkey, l_linenumber FROM {_CALLS} WHERE saf < 2 OR sar < 2")
def mask_sites(t: Tables) -> DataFrame:
    return _calls(t).where(G.strand_unsupported(F.col("saf"), F.col("sar"))).select("l_orderkey", "l_linenumber").distinct()


_PROMO_SQL = """(SELECT ((day(o_orderdate) - 1) * 1440 + (o_orderkey % 1440))::BIGINT AS s,
  ((day(o_orderdate) - 1) * 1440 + (o_orderkey % 1440) + 3)::BIGINT AS e FROM orders)"""


def _promos(t: Tables) -> DataFrame:
    s = long((F.day("o_orderdate") - 1) * 1440 + F.col("o_orderkey") % 1440)
    return t.orders.select(s.alias("start"), (s + 3).alias("end")).distinct()  # a month's minutes at most


@query(f"SELECT event_id, m FROM (SELECT event_id, {MINUTE_SQL} AS m FROM events) WHERE NOT EXISTS (SELECT 1 FROM {_PROMO_SQL} WHERE m BETWEEN s AND e)")
def region_exclusion(t: Tables) -> DataFrame:
    points = t.events.select("event_id", minute_of_month(F.col("ts")).alias("m"))
    return I.point_in_interval(points, _promos(t), [], "m", 60, how="left_anti")


@query("""SELECT p_partkey, ref, alt,
  CASE WHEN alt = '*' OR starts_with(alt, '<') THEN 'SKIP' WHEN length(ref) = 1 AND length(alt) = 1 THEN 'SNP'
       WHEN length(ref) = length(alt) THEN 'MNP' ELSE 'INDEL' END AS kind,
  CASE WHEN length(ref) = length(alt) THEN len(list_filter(range(1, length(ref) + 1), lambda i: ref[i] <> alt[i])) ELSE 0 END::BIGINT AS n_changed
FROM (SELECT p_partkey, split_part(p_type, ' ', 1) AS ref,
  CASE WHEN p_partkey % 7 = 0 THEN '*' WHEN p_partkey % 11 = 0 THEN '<DEL>' WHEN p_partkey % 3 = 0 THEN reverse(split_part(p_type, ' ', 1)) ELSE split_part(p_name, ' ', 1) END AS alt FROM part)""")
def variant_typing(t: Tables) -> DataFrame:
    ref = F.split_part("p_type", F.lit(" "), F.lit(1))
    alt = F.when(F.col("p_partkey") % 7 == 0, "*").when(F.col("p_partkey") % 11 == 0, "<DEL>").when(F.col("p_partkey") % 3 == 0, F.reverse(ref)).otherwise(F.split_part("p_name", F.lit(" "), F.lit(1)))
    v = t.part.select("p_partkey", ref.alias("ref"), alt.alias("alt"))
    same = F.length("ref") == F.length("alt")
    return v.select("p_partkey", "ref", "alt", G.variant_kind(F.col("ref"), F.col("alt")).alias("kind"), long(F.when(same, F.size(G.changed_bases(F.col("ref"), F.col("alt")))).otherwise(0)).alias("n_changed"))


@query(f"""SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, event_type AS kind, user_id::VARCHAR AS usr, {sql_q6('value')} AS val
FROM events""")
def kv_decode(t: Tables) -> DataFrame:
    text = F.concat_ws(";", F.concat(F.lit("kind="), "event_type"), F.concat(F.lit("usr="), "user_id"), F.lit("flag"))
    m = t.events.withColumn("m", S.kv_map(text))
    return m.select("event_id", long(F.get_json_object("props", "$.k")).alias("k"), F.col("m")["kind"].alias("kind"), F.col("m")["usr"].alias("usr"), S.q6("value").alias("val"))


_EFFECTS = ("missense_variant", "synonymous_variant", "stop_gained", "frameshift_variant", "intergenic_region", "splice_donor", "other_thing")


@query("""SELECT p_partkey, gene, effect, impact, cls FROM (
  SELECT p_partkey, p_name AS gene, effect, CASE WHEN p_size % 4 = 0 THEN 'MODIFIER' WHEN p_size % 4 = 1 THEN 'HIGH' WHEN p_size % 4 = 2 THEN 'MODERATE' ELSE 'LOW' END AS impact,
    CASE effect WHEN 'missense_variant' THEN 'missense' WHEN 'synonymous_variant' THEN 'synonymous' WHEN 'stop_gained' THEN 'stop_gained' WHEN 'frameshift_variant' THEN 'frameshift'
      WHEN 'intergenic_region' THEN 'intergenic' WHEN 'splice_donor' THEN 'splice' ELSE 'other' END AS cls
  FROM (SELECT *, ['missense_variant', 'synonymous_variant', 'stop_gained', 'frameshift_variant', 'intergenic_region', 'splice_donor', 'other_thing'][(p_partkey % 7)::INT + 1] AS effect FROM part))""")
def ann_parse(t: Tables) -> DataFrame:
    effect = F.element_at(F.array(*map(F.lit, _EFFECTS)), (F.col("p_partkey") % 7).cast("int") + 1)
    impact = F.element_at(F.array(*map(F.lit, ("", "HIGH", "MODERATE", "LOW"))), (F.col("p_size") % 4).cast("int") + 1)
    info = F.concat(F.lit("DP=3;ANN="), F.concat_ws("|", F.lit("A"), effect, impact, F.col("p_name"), F.col("p_brand")), F.lit(",B|x|LOW|other"))
    a = t.part.select("p_partkey", G.ann_fields(info).alias("a"))
    return a.select("p_partkey", F.col("a.gene").alias("gene"), F.col("a.effect").alias("effect"), F.col("a.impact").alias("impact"), G.effect_class(F.col("a.effect")).alias("cls"))


@query("""SELECT l_orderkey, l_linenumber, (l_orderkey & 2308) <> 0 AS unusable, (l_orderkey & 1) <> 0 AS paired, (l_orderkey & 1) <> 0 AND (l_orderkey & 2) <> 0 AND (l_orderkey & 12) = 0 AS proper
FROM lineitem WHERE (l_orderkey & 3844) = 0 OR l_linenumber = 1""")
def flag_bits(t: Tables) -> DataFrame:
    f = F.col("l_orderkey")
    kept = t.lineitem.where(~G.has_flags(f, 0xF04) | (F.col("l_linenumber") == 1))
    return kept.select("l_orderkey", "l_linenumber", G.has_flags(f, 0x904).alias("unusable"), G.has_flags(f, 1).alias("paired"), (G.has_flags(f, 1) & G.has_flags(f, 2) & ~G.has_flags(f, 12)).alias("proper"))


@query("SELECT l_orderkey, l_linenumber, (l_quantity::BIGINT + l_linenumber + l_partkey % 9 + 5)::BIGINT AS span FROM lineitem")
def cigar_span(t: Tables) -> DataFrame:
    c = F.concat(F.lit("4S"), long("l_quantity"), F.lit("M"), F.col("l_linenumber"), F.lit("D"), F.lit("7I"), (F.col("l_partkey") % 9), F.lit("N"), F.lit("5=2H"))
    return t.lineitem.select("l_orderkey", "l_linenumber", G.cigar_span(c).alias("span"))


@query(f"""SELECT l_orderkey, l_linenumber, dp2 AS dp, CASE WHEN gt = '0/1' AND ao + ro > 0 AND ro::DOUBLE / (ro + ao) < 0.1 THEN '1/1' ELSE gt END AS gt
FROM (SELECT *, CASE WHEN l_linenumber % 2 = 0 THEN '0/1' ELSE '1/1' END AS gt, coalesce(nullif(CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE dp::BIGINT END, 0), nullif(ro + ao, 0), 1)::BIGINT AS dp2 FROM {_CALLS})""")
def genotype_revalidation(t: Tables) -> DataFrame:
    c = _calls(t).withColumn("gt", F.when(F.col("l_linenumber") % 2 == 0, "0/1").otherwise("1/1")).withColumn("info_dp", F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(long("dp")))
    return V.revalidate(c, het_min=0.1).select("l_orderkey", "l_linenumber", long("dp").alias("dp"), "gt")


@query("""WITH track AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 65535 ELSE 35 + (c_custkey % 60) END::INT AS mul FROM customer),
r AS (SELECT o.o_orderkey, o.o_custkey, 36 + (o.o_orderkey % 80) AS span, o.o_orderkey % 2 = 0 AS paired, o.o_orderkey % 3 <> 0 AS proper, (o.o_custkey * 7) % (SELECT max(c_custkey) FROM customer) + 1 AS mate, 30 + (o.o_orderkey % 90) AS mspan FROM orders o),
k AS (SELECT r.*, s.mul IS NULL OR span >= s.mul OR (span < 35 AND s.mul <> 65535) AS own, m.mul IS NULL OR mspan >= m.mul OR (mspan < 35 AND m.mul <> 65535) AS other FROM r LEFT JOIN track s ON s.c_custkey = r.o_custkey LEFT JOIN track m ON m.c_custkey = r.mate)
SELECT o_orderkey, own OR (paired AND proper AND other) AS keep FROM k""")
def read_keep_mate_rescue(t: Tables) -> DataFrame:
    mul = F.when(F.col("c_custkey") % 5 == 0, 65535).otherwise(35 + F.col("c_custkey") % 60).cast("int")
    track = t.customer.select(F.col("c_custkey").alias("pos"), mul.alias("mul"))
    top = t.customer.agg(F.max("c_custkey").alias("top"))
    reads = t.orders.join(F.broadcast(top)).select(  # one row
        "o_orderkey", F.col("o_custkey").alias("pos"), (36 + F.col("o_orderkey") % 80).alias("span"), (F.col("o_orderkey") % 2 == 0).alias("paired"), (F.col("o_orderkey") % 3 != 0).alias("proper"),
        ((F.col("o_custkey") * 7) % F.col("top") + 1).alias("mate_pos"), (30 + F.col("o_orderkey") % 90).alias("mate_span"),
    )
    return V.keep_reads(reads, track, kmin=35).select("o_orderkey", "keep")


@query("""WITH b AS (SELECT user_id, date_trunc('day', ts)::DATE AS day, max(value) AS top, bool_or(event_type = 'error' AND value > 90) AS masked,
  list_sort(list(DISTINCT CASE event_type WHEN 'view' THEN 'A' WHEN 'click' THEN 'C' WHEN 'purchase' THEN 'G' WHEN 'signup' THEN 'T' END)
     FILTER (event_type <> 'error')) AS s FROM events GROUP BY ALL)
SELECT user_id, day, CASE WHEN masked THEN 'X' WHEN top <= 5 THEN '-' ELSE coalesce(map(['A','C','G','T','AG','CT','CG','AT','GT','AC','CGT','AGT','ACT','ACG','ACGT'], ['A','C','G','T','R','Y','S','W','K','M','B','D','H','V','N'])[array_to_string(s, '')], 'X') END AS base FROM b""")
def consensus_iupac(t: Tables) -> DataFrame:
    base = S.lookup(F.col("event_type"), {"view": "A", "click": "C", "purchase": "G", "signup": "T"})
    g = t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.max("value").alias("top"), F.bool_or((F.col("event_type") == "error") & (F.col("value") > 90)).alias("masked"), F.collect_set(base).alias("bases"))
    return g.select("user_id", "day", F.when(F.col("masked"), "X").when(F.col("top") <= 5, "-").otherwise(G.iupac(F.col("bases"))).alias("base"))


@query("SELECT p_partkey, i - 1 AS nth, split_part(p_name, ' ', i::INT) AS allele FROM part, range(1, 6) r(i) WHERE i <= len(string_split(p_name, ' '))")
def multiallelic_explode(t: Tables) -> DataFrame:
    return V.split_alleles(t.part.select("p_partkey", F.regexp_replace("p_name", " ", ",").alias("alt")), "alt").select("p_partkey", long("nth").alias("nth"), "allele")


@query(f"""SELECT h, dp, CASE WHEN dp >= 10 THEN '0' ELSE './.' END AS gt, CASE WHEN dp >= 10 THEN 1 ELSE 0 END AS wt, CASE WHEN dp >= 10 THEN 0 ELSE 1 END AS nc,
  CASE WHEN dp > 12 AND strict <= 12 THEN 'baq_dropout' ELSE 'PASS' END AS filter
FROM (SELECT {MINUTE_SQL} // 60 AS h, count(*) AS dp, count(*) FILTER (value > 20) AS strict FROM events GROUP BY 1)""")
def backbone_call(t: Tables) -> DataFrame:
    h = F.floor(minute_of_month(F.col("ts")) / 60)
    d = t.events.groupBy(h.alias("h")).agg(F.count(F.lit(1)).alias("dp"), F.count_if(F.col("value") > 20).alias("dp_baq"))
    return V.backbone(d, mincov=10, gap=12).select("h", "dp", "gt", "wt", "nc", "filter")


@query("""WITH o AS (SELECT p_partkey, p_size % 4 AS ref, (p_size + p_partkey) % 4 AS alt, CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_partkey % 4 END AS og FROM part)
SELECT CASE WHEN og IS NULL THEN 'unreadable' WHEN og = ref THEN 'derived' WHEN og = alt THEN 'ancestral' ELSE 'third' END AS polarity, count(*) AS n FROM o WHERE ref <> alt GROUP BY 1""")
def polarity(t: Tables) -> DataFrame:
    o = t.part.select((F.col("p_size") % 4).alias("ref"), ((F.col("p_size") + F.col("p_partkey")) % 4).alias("alt"), F.when(F.col("p_partkey") % 6 != 0, F.col("p_partkey") % 4).alias("og"))
    return o.where("ref <> alt").groupBy(V.polarity(F.col("ref"), F.col("alt"), F.col("og")).alias("polarity")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH c AS (SELECT p_partkey, p_size, p_retailprice FROM part), m AS (SELECT p_partkey AS src, CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_partkey * 2 + 1 END AS tgt, CASE WHEN p_partkey % 2 = 0 THEN '-' ELSE '+' END AS strand, substr('ACGT', (p_size % 4)::INT + 1, 1) AS canon FROM part),
v AS (SELECT p_partkey AS pos, substr('ACGT', ((p_size + p_partkey) % 4)::INT + 1, 1) AS alt FROM part)
SELECT pos AS opos, tgt AS pos, CASE WHEN strand = '-' THEN translate(alt, 'ACGT', 'TGCA') ELSE alt END AS alt, canon AS ref FROM v JOIN m ON v.pos = m.src
WHERE tgt IS NOT NULL AND CASE WHEN strand = '-' THEN translate(alt, 'ACGT', 'TGCA') ELSE alt END <> canon""")
def lift_join(t: Tables) -> DataFrame:
    base = lambda n: F.substring(F.lit("ACGT"), (n % 4).cast("int") + 1, F.lit(1))
    m = t.part.select(F.col("p_partkey").alias("src_pos"), F.when(F.col("p_partkey") % 9 != 0, F.col("p_partkey") * 2 + 1).alias("tgt_pos"), F.when(F.col("p_partkey") % 2 == 0, "-").otherwise("+").alias("strand"), base(F.col("p_size")).alias("canon"))
    v = t.part.select(F.col("p_partkey").alias("pos"), base(F.col("p_size") + F.col("p_partkey")).alias("alt"))
    return V.lift(v, m).select("opos", "pos", "alt", "ref")


@query("""SELECT l_partkey, count(*) FILTER (l_returnflag = 'R') AS acceptor, count(*) FILTER (l_returnflag = 'A') AS donor, count(*) FILTER (l_returnflag NOT IN ('R', 'A')) AS other, count(*) AS depth,
  """ + sql_q6("CASE WHEN count(*) FILTER (l_returnflag IN ('R', 'A')) > 0 THEN count(*) FILTER (l_returnflag = 'A')::DOUBLE / count(*) FILTER (l_returnflag IN ('R', 'A')) END") + " AS donor_af FROM lineitem GROUP BY 1")
def allele_pileup(t: Tables) -> DataFrame:
    p = V.pileup(t.lineitem.select(F.col("l_partkey").alias("pos"), F.col("l_returnflag").alias("base"), F.lit("R").alias("acceptor"), F.lit("A").alias("donor")), ["pos"])
    return p.select(F.col("pos").alias("l_partkey"), F.col("n_acceptor").alias("acceptor"), F.col("n_donor").alias("donor"), F.col("n_other").alias("other"), "depth", S.q6("donor_af").alias("donor_af"))


@query("""WITH r AS (SELECT l_orderkey, count(*) FILTER (l_linenumber <= 3 AND l_returnflag = 'A') AS din, count(*) FILTER (l_linenumber <= 3 AND l_returnflag <> 'A') AS ain,
  count(*) FILTER (l_linenumber > 3 AND l_returnflag = 'A') AS dout, count(*) FILTER (l_linenumber > 3 AND l_returnflag <> 'A') AS aout FROM lineitem GROUP BY 1)
SELECT count(*) FILTER (din > 0 AND ain = 0 AND aout > 0) AS cis, count(*) FILTER (din > 0 AND ain > 0) AS breakpoint, count(*) FILTER (din > 0 AND ain = 0 AND aout = 0) AS donor_only, count(*) AS molecules FROM r""")
def linkage_counts(t: Tables) -> DataFrame:
    obs = t.lineitem.select(F.col("l_orderkey").alias("read"), (F.col("l_linenumber") <= 3).alias("inside"), (F.col("l_returnflag") == "A").alias("is_donor"))
    return V.linkage(obs, [])


@query("""WITH d AS (SELECT l_linestatus, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL), g AS (SELECT l_linestatus, avg(n) AS genome FROM d GROUP BY 1),
l AS (SELECT l_linestatus, p_brand, median(n) FILTER (n >= 8)::DOUBLE AS locus FROM d JOIN part ON p_partkey = l_partkey GROUP BY ALL)
SELECT l_linestatus, p_brand, """ + sql_q6("locus / genome") + """ AS ratio, CASE WHEN locus IS NOT NULL THEN greatest(1, round_even(locus / genome, 0))::BIGINT END AS copies, """ + sql_q6("1.0 / CASE WHEN locus IS NOT NULL THEN greatest(1, round_even(locus / genome, 0)) END") + " AS expected_af FROM l JOIN g USING (l_linestatus)")
def copy_number(t: Tables) -> DataFrame:
    depth = t.lineitem.groupBy("l_linestatus", "l_partkey").agg(F.count(F.lit(1)).alias("dp"))
    genome = depth.groupBy("l_linestatus").agg(F.avg("dp").alias("genome_depth"))
    sites = depth.join(t.part.select("p_partkey", "p_brand"), F.col("p_partkey") == F.col("l_partkey"))
    c = V.copy_number(sites, genome, ["p_brand"], "dp", ["l_linestatus"], 8)
    return c.select("l_linestatus", "p_brand", S.q6("ratio").alias("ratio"), "copies", S.q6("expected_af").alias("expected_af"))


def _assemblies(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Two assemblies with a contig for each region, and the middle of each customer's stretch on the first one.

    A customer has 64 bases. The second assembly lacks some customers and eight bases of others, and some lie reversed.
    """
    dna = lambda c: F.translate(F.sha2(c, 256), "0123456789abcdef", "ACGTACGTACGTACGT")
    own = t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 nations by the schema
    own = own.select(F.concat(F.lit("r"), "n_regionkey").alias("contig"), F.col("c_custkey").alias("id"), dna(F.col("c_name")).alias("bases"))
    whole = lambda df, bases: df.groupBy("contig").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("id", bases.alias("b")))), lambda x: x["b"]), "").alias("seq"))
    second = F.when(F.col("id") % 7 == 1, F.substring("bases", 1, 56)).when(F.col("id") % 11 == 4, G.revcomp(F.col("bases"))).otherwise(F.col("bases"))
    starts = own.groupBy("contig").agg(F.sort_array(F.collect_list("id")).alias("ids")).select("contig", F.posexplode("ids").alias("n", "id"))
    return whole(own, F.col("bases")), whole(own.where("id % 50 <> 3"), second), starts.select("contig", (F.col("n") * 64 + 32).cast("bigint").alias("pos"))


@query()
def anchor_lift(t: Tables) -> DataFrame:
    from strandwise.operators.lift import LiftParams, lift_positions

    source, target, places = _assemblies(t)
    return lift_positions(places, source, target, LiftParams(align=True))


@query()
def lost_regions(t: Tables) -> DataFrame:
    from strandwise.operators import lift as L

    source, target, _ = _assemblies(t)
    return L.lost_regions(L.chain_links(L.unique_anchors(source, target), backbone=True))


#: CIGARs of 12 bases, by line number
_CIGARS = ("12M", "4M2D8M", "3M1I8M", "5M4N7M", "2S10M", "6M1D2M1I3M", "12M")


@query("""WITH r AS (SELECT 'c' || (l_suppkey % 3) AS contig, (l_partkey * 3)::BIGINT AS pos, l_linenumber AS k, translate(substr(sha256(l_orderkey || '-' || l_linenumber), 1, 12), '0123456789abcdef', 'ACGTACGTACGTACGN') AS seq, substr(sha256(l_orderkey || '+' || l_linenumber), 1, 12) AS qual FROM lineitem),
m AS (SELECT * FROM (VALUES (1, 0, 0, 12, 'M'), (2, 0, 0, 4, 'M'), (2, 4, 4, 2, 'D'), (2, 6, 4, 8, 'M'), (3, 0, 0, 3, 'M'), (3, 3, 4, 8, 'M'), (4, 0, 0, 5, 'M'), (4, 5, 5, 4, 'N'), (4, 9, 5, 7, 'M'), (5, 0, 2, 10, 'M'),
  (6, 0, 0, 6, 'M'), (6, 6, 6, 1, 'D'), (6, 7, 6, 2, 'M'), (6, 9, 9, 3, 'M'), (7, 0, 0, 12, 'M')) AS v(k, r, q, n, op)),
b AS (SELECT contig, pos + m.r + i AS pos, CASE WHEN op = 'M' THEN substr(seq, (m.q + i + 1)::INT, 1) ELSE op END AS base, substr(qual, (m.q + CASE WHEN op = 'M' THEN i ELSE 0 END + 1)::INT, 1) AS q, op FROM r JOIN m USING (k), unnest(range(m.n)) AS u(i)),
f AS (SELECT contig, pos, base, op, count(*) AS n FROM b WHERE ascii(q) - 33 >= 20 GROUP BY ALL),
axis AS (SELECT 'c' || c AS contig, unnest(range(1, (SELECT max(p_partkey) * 3 + 1 FROM part))) AS pos FROM range(4) AS t(c))
SELECT a.contig, a.pos, """ + ", ".join(f"coalesce(sum(n) FILTER (op = 'M' AND base = '{x.upper()}'), 0)::BIGINT AS {x}" for x in "acgtn") + """, coalesce(sum(n) FILTER (op = 'D'), 0)::BIGINT AS deleted, coalesce(sum(n) FILTER (op = 'N'), 0)::BIGINT AS skipped, coalesce(sum(n), 0)::BIGINT AS depth
FROM axis a LEFT JOIN f USING (contig, pos) GROUP BY 1, 2""")
def dense_pileup(t: Tables) -> DataFrame:
    from strandwise.operators.pileup import PileupParams, dense_pileup as run

    digest = lambda mark: F.substring(F.sha2(F.concat("l_orderkey", F.lit(mark), "l_linenumber"), 256), 1, 12)
    cigar = F.element_at(F.array(*[F.lit(c) for c in _CIGARS]), F.col("l_linenumber").cast("int"))
    reads = t.lineitem.select(F.concat(F.lit("c"), F.col("l_suppkey") % 3).alias("rname"), (F.col("l_partkey") * 3).cast("bigint").alias("pos"), cigar.alias("cigar"), F.translate(digest("-"), "0123456789abcdef", "ACGTACGTACGTACGN").alias("seq"), digest("+").alias("qual"))
    length = t.part.agg((F.max("p_partkey") * 3).alias("length"))  # one row; contig c3 has no reads
    axis = length.select(F.explode(F.array(*[F.lit(f"c{c}") for c in range(4)])).alias("contig"), "length")
    return run(reads, axis, (), PileupParams(min_qual=20))


@query("""WITH b AS (SELECT s_nationkey % 5 AS c, s_suppkey AS id, translate(sha256(CASE WHEN s_suppkey % 4 = 1 THEN 'n' || (s_suppkey % 60) ELSE s_name END), '0123456789abcdef', 'ACGTACGTACGTACGT') AS bases FROM supplier),
g AS (SELECT 'n' || c AS contig, string_agg(bases, '' ORDER BY id) AS seq FROM b GROUP BY c), w AS (SELECT contig, seq, unnest(range(1, length(seq) + 1)) AS pos FROM g),
k AS (SELECT contig, pos, k, substr(seq, pos, k) AS w FROM w, unnest(range(1, 101)) AS u(k) WHERE pos + k - 1 <= length(seq)), c AS (SELECT *, least(w, reverse(translate(w, 'ACGT', 'TGCA'))) AS canon FROM k),
u AS (SELECT min(contig) AS contig, min(pos) AS pos, k FROM c WHERE w <> reverse(translate(w, 'ACGT', 'TGCA')) GROUP BY canon, k HAVING count(*) = 1)
SELECT w.contig, w.pos::BIGINT AS pos, min(k)::INT AS mul FROM w LEFT JOIN u ON u.contig = w.contig AND u.pos = w.pos GROUP BY 1, 2""")
def least_unique_length(t: Tables) -> DataFrame:
    """Assemblies made of suppliers: a quarter of their stretches comes again."""
    from strandwise.operators.uniqueness import UniqueParams, least_unique_lengths

    name = F.when(F.col("s_suppkey") % 4 == 1, F.concat(F.lit("n"), F.col("s_suppkey") % 60)).otherwise(F.col("s_name"))
    own = t.supplier.select(F.concat(F.lit("n"), F.col("s_nationkey") % 5).alias("contig"), F.struct(F.col("s_suppkey").alias("id"), F.translate(F.sha2(name, 256), "0123456789abcdef", "ACGTACGTACGTACGT").alias("b")).alias("x"))
    seqs = own.groupBy("contig").agg(F.array_join(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["b"]), "").alias("seq"))
    return least_unique_lengths(seqs, UniqueParams(longest=100)).select("contig", "pos", "mul")


@query(f"""WITH o AS (SELECT 'g' || (l_orderkey % 40) AS gene, l_orderkey AS read, (l_orderkey % 40 * 10 + l_linenumber)::BIGINT AS pos, l_linenumber AS n, substr('ACGT', (l_partkey % 4)::INT + 1, 1) AS base FROM lineitem WHERE l_linenumber <= 6),
h AS (SELECT DISTINCT gene, (n - 1) // 3 + 1 AS codon, (n - 1) % 3 + 1 AS place, pos, translate(substr(sha256(gene || '/' || ((n - 1) // 3 + 1)), 1, 3), '0123456789abcdef', 'ACGTACGTACGTACGT') AS ref_codon, substr(translate(substr(sha256(gene || '+' || n), 1, 1), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 1) AS alt FROM o),
s AS (SELECT *, substr(ref_codon, place::INT, 1) AS ref FROM h WHERE alt <> substr(ref_codon, place::INT, 1)),
c AS (SELECT gene, codon, any_value(ref_codon) AS ref_codon, string_agg(pos, ',' ORDER BY place) AS positions, list({{'p': place, 'a': alt}} ORDER BY place) AS x, count(*) AS k FROM s GROUP BY ALL HAVING count(*) >= 2),
m AS (SELECT s.gene, s.codon, read, count(DISTINCT s.place) AS shows, count(DISTINCT CASE WHEN base = alt THEN s.place END) AS carries FROM o JOIN s ON o.gene = s.gene AND o.pos = s.pos GROUP BY ALL),
r AS (SELECT c.gene, c.codon, count(*) FILTER (carries = k) AS mnv_reads, count(*) FILTER (carries BETWEEN 1 AND k - 1) AS partial_reads, count(*) AS total_reads FROM c JOIN m ON m.gene = c.gene AND m.codon = c.codon AND shows = k GROUP BY ALL)
SELECT c.gene, c.codon::BIGINT AS codon, positions, ref_codon, list_reduce(list_concat([ref_codon], list_transform(x, lambda e: e.p || e.a)), lambda acc, e: substr(acc, 1, substr(e, 1, 1)::INT - 1) || substr(e, 2, 1) || substr(acc, substr(e, 1, 1)::INT + 1)) AS mnv_codon,
  coalesce(mnv_reads, 0) AS mnv_reads, coalesce(partial_reads, 0) AS partial_reads, coalesce(total_reads, 0) AS total_reads, {sql_q6('mnv_reads::DOUBLE / total_reads')} AS mnv_frequency, CASE WHEN coalesce(mnv_reads, 0) < 2 THEN 'SNP' WHEN partial_reads > 0 THEN 'SNP/MNV' ELSE 'MNV' END AS kind
FROM c LEFT JOIN r ON r.gene = c.gene AND r.codon = c.codon""")
def phased_codon_changes(t: Tables) -> DataFrame:
    from strandwise.operators.phasing import phased_codons

    dna = lambda c, n: F.translate(F.substring(F.sha2(c, 256), 1, n), "0123456789abcdef", "ACGTACGTACGTACGT")
    own = t.lineitem.where("l_linenumber <= 6").withColumn("gene", F.concat(F.lit("g"), F.col("l_orderkey") % 40))
    obs = own.select(F.lit("c").alias("contig"), "gene", F.col("l_linenumber").alias("n"), F.col("l_orderkey").alias("read"), (F.col("l_orderkey") % 40 * 10 + F.col("l_linenumber")).cast("bigint").alias("pos"), F.substring(F.lit("ACGT"), (F.col("l_partkey") % 4).cast("int") + 1, F.lit(1)).alias("base"))
    codon = (F.floor((F.col("n") - 1) / 3) + 1).cast("bigint")
    sites = obs.select("contig", "gene", codon.alias("codon"), ((F.col("n") - 1) % 3 + 1).cast("int").alias("place"), "pos", F.lit("+").alias("strand"), dna(F.concat("gene", F.lit("/"), codon), 3).alias("ref_codon"), dna(F.concat("gene", F.lit("+"), "n"), 1).alias("alt")).distinct()
    got = phased_codons(obs.select("contig", "read", "pos", "base"), sites, (), 2)
    return got.select("gene", "codon", "positions", "ref_codon", "mnv_codon", "mnv_reads", "partial_reads", "total_reads", S.q6("mnv_frequency").alias("mnv_frequency"), "kind")


@query(f"""WITH o AS (SELECT l_orderkey // 40 AS locus, l_orderkey AS read, l_linenumber * 100 AS pos, CASE WHEN l_returnflag = 'A' THEN 'donor' WHEN l_returnflag = 'R' THEN 'acceptor' ELSE 'other' END AS call, l_linestatus = 'O' AS sw FROM lineitem),
s AS (SELECT locus, pos, count(*) AS depth, count(*) FILTER (call = 'donor')::DOUBLE / nullif(count(*) FILTER (call <> 'other'), 0) AS af, avg(sw::INT) AS sw, CASE WHEN pos BETWEEN 300 AND 500 THEN 300 WHEN pos = 700 AND locus % 2 = 0 THEN 700 END AS t FROM o GROUP BY ALL),
d AS (SELECT *, depth >= 5 AND af IS NOT NULL AS sure FROM s), i AS (SELECT locus, t, count(*) AS n_sites, count(*) FILTER (NOT sure) AS und, min(pos) AS a, max(pos) AS z, avg(af) AS af_in, min(depth) AS low, count(*) AS k, avg(sw) AS sw FROM d WHERE t IS NOT NULL GROUP BY ALL),
f AS (SELECT locus, count(*) AS n, avg(af) AS af FROM d WHERE t IS NULL AND sure GROUP BY 1), x AS (SELECT i.locus, i.t, count(*) AS k, avg(d.sw) AS sw FROM i JOIN d ON d.locus = i.locus AND NOT d.pos BETWEEN i.t AND CASE i.t WHEN 300 THEN 500 ELSE 700 END GROUP BY ALL),
m AS (SELECT DISTINCT o.locus, read, o.pos, call, t, sure FROM o JOIN d ON d.locus = o.locus AND d.pos = o.pos WHERE call <> 'other'),
y AS (SELECT locus, read, bool_or(t IS NULL AND sure AND call = 'acceptor') AS acc, bool_or(t IS NULL AND sure AND call = 'donor') AS don FROM m GROUP BY ALL),
r AS (SELECT q.locus, q.t, count(*) FILTER (n >= 2) AS cis, count(*) FILTER (acc) AS cut, count(*) FILTER (don AND NOT acc) AS only_ FROM (SELECT locus, read, t, count(*) AS n FROM m WHERE t IS NOT NULL AND call = 'donor' GROUP BY ALL) q JOIN y ON y.locus = q.locus AND y.read = q.read GROUP BY ALL)
SELECT i.locus, a::BIGINT AS start, z::BIGINT AS "end", n_sites, und AS n_undetermined, coalesce(f.n, 0) AS n_sites_outside, {sql_q6('round(af_in, 4)')} AS donor_af_in, {sql_q6('round(f.af, 4)')} AS donor_af_outside, low AS lowest_depth,
  coalesce(cis, 0) AS cis_reads, coalesce(cut, 0) AS breakpoint_reads, coalesce(only_, 0) AS donor_only_reads, {sql_q6('CASE WHEN i.k >= 2 AND x.k >= 2 THEN i.sw END')} AS swap_in, {sql_q6('CASE WHEN i.k >= 2 AND x.k >= 2 THEN x.sw END')} AS swap_out,
  coalesce(i.k >= 2 AND x.k >= 2 AND i.sw >= 0.5 AND x.sw < 0.5, false) AS exchange, CASE WHEN 2 * und > n_sites THEN 'depth' WHEN round(af_in, 4) < 0.1 THEN 'trickle' END AS unreadable
FROM i LEFT JOIN f ON f.locus = i.locus LEFT JOIN x ON x.locus = i.locus AND x.t = i.t LEFT JOIN r ON r.locus = i.locus AND r.t = i.t""")
def tract_evidence(t: Tables) -> DataFrame:
    from strandwise.operators.tracts import tract_evidence as run

    call = F.when(F.col("l_returnflag") == "A", "donor").when(F.col("l_returnflag") == "R", "acceptor").otherwise("other")
    obs = t.lineitem.select(F.floor(F.col("l_orderkey") / 40).alias("locus"), F.col("l_orderkey").alias("read"), (F.col("l_linenumber") * 100).cast("bigint").alias("pos"), call.alias("call"), (F.col("l_linestatus") == "O").cast("int").alias("sw"))
    sites = obs.groupBy("locus", "pos").agg(F.count(F.lit(1)).alias("depth"), F.try_divide(F.count_if(F.col("call") == "donor"), F.count_if(F.col("call") != "other")).alias("donor_af"), F.avg("sw").alias("af"))
    first, last = F.lit(300).cast("bigint"), F.lit(700).cast("bigint")
    loci = obs.select("locus").distinct()
    tracts = loci.select("locus", first.alias("start"), (first + 200).alias("end")).union(loci.where("locus % 2 = 0").select("locus", last, last))
    out = run(tracts, sites.drop("af"), obs.drop("sw"), ["locus"], sites.select("locus", "pos", "af"))
    return out.drop("span_bp").withColumns({c: S.q6(c) for c in ("donor_af_in", "donor_af_outside", "swap_in", "swap_out")})
