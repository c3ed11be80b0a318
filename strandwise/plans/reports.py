"""Queries that put the driver tables in the roles of deletions, anchors, read pairs, coding sequences and tracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.functions import genomics as G
from strandwise.operators import kernels as K
from strandwise.operators import lift as L
from strandwise.operators import taxonomy as X
from strandwise.operators import variants as V
from strandwise.plans.base import Tables, long, query


@query("""WITH c AS (SELECT l_linestatus AS cohort, l_partkey % 60 AS deletion, count(DISTINCT l_suppkey) AS carriers FROM lineitem WHERE l_quantity > 46 + l_partkey % 5 GROUP BY ALL),
n AS (SELECT l_linestatus AS cohort, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1)
SELECT c.cohort, deletion, carriers, CASE WHEN n < 2 THEN 'alone' WHEN carriers >= greatest(2, ceil(0.9 * n)) THEN 'cohort' WHEN carriers >= 2 THEN 'shared' ELSE 'private' END AS class FROM c JOIN n ON c.cohort = n.cohort""")
def deletion_classes(t: Tables) -> DataFrame:
    own = t.lineitem.select(F.col("l_linestatus").alias("cohort"), (F.col("l_partkey") % 60).alias("deletion"), "l_suppkey", (F.col("l_quantity") > 46 + F.col("l_partkey") % 5).alias("has"))
    carriers = own.where("has").groupBy("cohort", "deletion").agg(F.count_distinct("l_suppkey").alias("carriers"))
    n = own.groupBy("cohort").agg(F.count_distinct("l_suppkey").alias("n"))
    return carriers.join(n, "cohort").select("cohort", "deletion", "carriers", K.deletion_class(F.col("carriers"), F.col("n")).alias("class"))


@query("""WITH a AS (SELECT DISTINCT l_returnflag AS src_contig, l_partkey AS src_pos, l_linestatus AS tgt_contig, l_suppkey * 20 AS tgt_pos FROM lineitem),
d AS (SELECT *, row_number() OVER w AS i, abs(src_pos - tgt_pos) AS d, lead(abs(src_pos - tgt_pos)) OVER w AS after FROM a WINDOW w AS (PARTITION BY src_contig, src_pos ORDER BY abs(src_pos - tgt_pos), tgt_contig, tgt_pos))
SELECT src_contig, src_pos, tgt_contig, tgt_pos FROM d WHERE i = 1 AND d <= 120 AND (after IS NULL OR after - d >= 40)""")
def synteny_choice(t: Tables) -> DataFrame:
    a = t.lineitem.select(F.col("l_returnflag").alias("src_contig"), F.col("l_partkey").alias("src_pos"), F.col("l_linestatus").alias("tgt_contig"), (F.col("l_suppkey") * 20).alias("tgt_pos")).distinct()
    return L.classify_synteny(a, 120, 40)


@query("""SELECT rname, pos, strand, mate_pos, qname, qual_sum FROM (SELECT l_suppkey % 20 AS rname, l_partkey AS pos, l_linestatus AS strand, l_linenumber AS mate_pos, l_orderkey || '-' || l_linenumber AS qname, l_quantity AS qual_sum FROM lineitem)
QUALIFY row_number() OVER (PARTITION BY rname, pos, strand, mate_pos ORDER BY qual_sum DESC, qname) = 1""")
def duplicate_reads(t: Tables) -> DataFrame:
    reads = t.lineitem.select((F.col("l_suppkey") % 20).alias("rname"), F.col("l_partkey").alias("pos"), F.col("l_linestatus").alias("strand"), F.col("l_linenumber").alias("mate_pos"), F.concat("l_orderkey", F.lit("-"), "l_linenumber").alias("qname"), F.col("l_quantity").alias("qual_sum"))
    return X.mark_duplicates(reads)


@query("""WITH c AS (SELECT DISTINCT o_custkey AS k, o_orderstatus AS contig FROM orders), n AS (SELECT k, count(*) AS n FROM c GROUP BY 1)
SELECT c_name AS sample, contig, CASE WHEN n > 1 THEN c_name || '_' || contig ELSE c_name END AS header FROM c JOIN n ON n.k = c.k JOIN customer ON c_custkey = c.k""")
def consensus_headers(t: Tables) -> DataFrame:
    contigs = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderstatus").alias("contig")).distinct()
    n = contigs.groupBy("c_custkey").agg(F.count(F.lit(1)).alias("n"))
    both = contigs.join(n, "c_custkey").join(t.customer.select("c_custkey", F.col("c_name").alias("sample")), "c_custkey")
    return both.select("sample", "contig", X.consensus_header(F.col("sample"), F.col("contig"), F.col("n")).alias("header"))


def _aa(codon: str) -> str:
    at = lambda i: f"(instr('TCAG', substr({codon}, {i}, 1)) - 1)"
    return f"substr('{G._CODE}', ({at(1)} * 16 + {at(2)} * 4 + {at(3)} + 1)::INT, 1)"


@query(f"""WITH g AS (SELECT s_suppkey, translate(sha256(s_name), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq, CASE WHEN s_suppkey % 2 = 0 THEN '-' ELSE '+' END AS strand, (s_suppkey % 3)::BIGINT AS phase FROM supplier),
s AS (SELECT DISTINCT l_suppkey, (1 + (l_linenumber * 9 + l_partkey) % 64)::BIGINT AS pos, substr('ACGT', (l_partkey % 4)::INT + 1, 1) AS alt FROM lineitem),
a AS (SELECT *, CASE WHEN strand = '+' THEN pos - 5 ELSE 61 - pos END - phase AS along FROM s JOIN g ON s_suppkey = l_suppkey), b AS (SELECT *, floor(along / 3)::BIGINT AS k FROM a),
c AS (SELECT *, CASE WHEN strand = '+' THEN 5 + phase + k * 3 ELSE 61 - phase - k * 3 - 2 END AS low FROM b), d AS (SELECT *, along >= 0 AND low >= 5 AND low + 2 <= 61 AS fits, substr(seq, low, 3) AS three FROM c WHERE low >= 1),
e AS (SELECT *, substr(three, 1, pos - low) || alt || substr(three, pos - low + 2) AS changed FROM d), f AS (SELECT *, CASE WHEN strand = '+' THEN three ELSE reverse(translate(three, 'ACGT', 'TGCA')) END AS x, CASE WHEN strand = '+' THEN changed ELSE reverse(translate(changed, 'ACGT', 'TGCA')) END AS y FROM e WHERE fits),
h AS (SELECT *, {_aa('x')} AS ref_aa, {_aa('y')} AS alt_aa FROM f)
SELECT l_suppkey, pos, alt, k + 1 AS codon, ref_aa, alt_aa, CASE WHEN ref_aa = alt_aa THEN 'synonymous' ELSE 'nonsynonymous' END AS change FROM h""")
def codon_consequence(t: Tables) -> DataFrame:
    genes = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.translate(F.sha2("s_name", 256), "0123456789abcdef", "ACGTACGTACGTACGT").alias("seq"), F.when(F.col("s_suppkey") % 2 == 0, "-").otherwise("+").alias("strand"), long(F.col("s_suppkey") % 3).alias("phase"), F.lit(5).cast("bigint").alias("start"), F.lit(61).cast("bigint").alias("end"))
    sites = t.lineitem.select("l_suppkey", long(1 + (F.col("l_linenumber") * 9 + F.col("l_partkey")) % 64).alias("pos"), F.substring(F.lit("ACGT"), (F.col("l_partkey") % 4).cast("int") + 1, F.lit(1)).alias("alt")).distinct()
    return V.codon_change(sites.join(genes, "l_suppkey")).where("codon IS NOT NULL").select("l_suppkey", "pos", "alt", "codon", "ref_aa", "alt_aa", "change")


@query("""WITH t AS (SELECT s_name AS tract, 'n' || s_nationkey AS contig, s_suppkey * 37 % 5000 AS a, s_suppkey * 37 % 5000 + 300 AS z FROM supplier), f AS (SELECT 'n' || (p_partkey % 25) AS contig, p_partkey * 13 % 5300 AS a, p_partkey * 13 % 5300 + 20 AS z, p_brand AS name FROM part),
c AS (SELECT 'n' || (l_partkey % 25) AS contig, (l_partkey * 7 + l_linenumber) % 5300 AS pos, CASE l_returnflag WHEN 'A' THEN 'synonymous' WHEN 'R' THEN 'nonsynonymous' ELSE 'other' END AS change, l_returnflag || l_linenumber AS label FROM lineitem),
g AS (SELECT tract, name, min(f.a) AS first FROM t JOIN f ON t.contig = f.contig AND t.a <= f.z AND f.a <= t.z GROUP BY ALL), gs AS (SELECT tract, string_agg(name, ',' ORDER BY first, name) AS genes FROM g GROUP BY 1),
cs AS (SELECT tract, count(*) FILTER (change = 'synonymous') AS s, count(*) FILTER (change = 'nonsynonymous') AS n, string_agg(DISTINCT label, ',' ORDER BY label) AS changes FROM t JOIN c ON t.contig = c.contig AND pos BETWEEN t.a AND t.z GROUP BY 1)
SELECT t.tract, coalesce(genes, '') AS genes, coalesce(s, 0) AS n_syn, coalesce(n, 0) AS n_nonsyn, coalesce(changes, '') AS changes FROM t LEFT JOIN gs ON gs.tract = t.tract LEFT JOIN cs ON cs.tract = t.tract""")
def tract_genes(t: Tables) -> DataFrame:
    contig = lambda c: F.concat(F.lit("n"), c)
    first = F.col("s_suppkey") * 37 % 5000
    tracts = t.supplier.select(F.col("s_name").alias("tract"), contig("s_nationkey").alias("contig"), first.alias("start"), (first + 300).alias("end"))
    at = F.col("p_partkey") * 13 % 5300
    features = t.part.select(contig(F.col("p_partkey") % 25).alias("contig"), at.alias("start"), (at + 20).alias("end"), F.col("p_brand").alias("name"))
    kind = F.when(F.col("l_returnflag") == "A", "synonymous").when(F.col("l_returnflag") == "R", "nonsynonymous").otherwise("other")
    changes = t.lineitem.select(contig(F.col("l_partkey") % 25).alias("contig"), ((F.col("l_partkey") * 7 + F.col("l_linenumber")) % 5300).alias("pos"), kind.alias("change"), F.concat("l_returnflag", "l_linenumber").alias("label"))
    return X.tract_annotation(tracts, features, changes, 400).select("tract", "genes", "n_syn", "n_nonsyn", "changes")
