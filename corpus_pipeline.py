"""The corpus pipeline: language ID, exact dedup, SimHash near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwise.llm import exact_dedup, language, mixing, packing, similar
from strandwise.session import staged

#: Rows of whole texts that go to Python at once; it bounds the buffers on both sides and has no part in the results.
BATCH_ROWS = 500

#: Words whose ids a worker of the packing stage remembers; workers live on and keep what they once held. Speed only.
CACHE_WORDS = 150_000

#: A text stays whose language is known with this score at least; sure predictions score far above it.
LEAST_SCORE = 0.4


def small_batches(spark: SparkSession) -> None:
    """Sets the session's Arrow batches; a plan reads the setting when it runs, after its stage has returned."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that are `und`, as null ones and those without a letter are, or whose language is uncertain.

    Each row is judged by its text alone, so repeated rows fare alike; no labelled rows leave nothing to keep.
    """
    small_batches(spark)
    net = language.learn(docs.where(language.fold("doc_id", 4) != 2), order=F.col("doc_id"))
    found = language.identify(docs, net, lang_name="_lang", score_name="_score")
    return found.where((F.col("_lang") != language.UNDETERMINED) & (F.col("_score") >= LEAST_SCORE)).select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the largest doc_id of equal texts: one row of each text, null and empty being one; a null id only if no other has it."""
    return exact_dedup.exact_dedup(docs, carry=docs.columns).where("kept").select("carried.*")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each class of near duplicates: texts with a 5-word Jaccard similarity of 0.8 or more.

    Rows are told apart by id and text, so an id with two texts is two documents; a null id is kept only if a class has
    no other, and rows that repeat both stay or go together.
    """
    small_batches(spark)
    return similar.drop_similar(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples documents so that sources, languages and topics meet their targets; null names are categories of their own."""
    return mixing.mix(docs, prefix="_mix_").where("_mix_sampled").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places all documents in sequences; null and empty texts as their end token alone."""
    small_batches(spark)
    return packing.pack(docs, params=packing.PackingParams(cache_words=CACHE_WORDS))


STAGES = [("language_id", language_id), ("exact_dedup", exact), ("simhash_dedup", near), ("mixing", mix), ("packing", pack)]

#: Neither the network, the raking nor the tokens can be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
