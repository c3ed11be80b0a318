"""What the query modules share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The driver tables of a folder, read where they are named."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None):
    """Register a function of Tables under its own name, with the DuckDB SQL of the same rows."""

    def put(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


def long(x: Column | str) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("bigint")


def minute_of_month(ts: Column) -> Column:
    return ((F.day(ts) - 1) * 1440 + F.hour(ts) * 60 + F.minute(ts)).cast("bigint")


MINUTE_SQL = "((day(ts) - 1) * 1440 + hour(ts) * 60 + minute(ts))::BIGINT"


def sql_q6(x: str) -> str:
    return f"floor(({x})::DOUBLE * 1e6 + 0.5) / 1e6"
