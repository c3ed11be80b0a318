"""Streaming forms of three batch operators, as an extension: a line filter, complete groups, and time windows.

Event times without a time zone can't carry a watermark: cast them to timestamp first, in a session whose zone is UTC.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def read_events(spark, path: str, schema: str, files_per_batch: int = 16) -> DataFrame:
    """A folder of parquet files as a stream, `ts` as a timestamp."""
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


def keep(stream: DataFrame, cond: Column) -> DataFrame:
    """A stateless filter: rows pass as they come."""
    return stream.where(cond)


def windowed_depth(stream: DataFrame, keys: list[str], value: str, size: str = "1 day", late: str = "1 hour", callable_at: float = 30) -> DataFrame:
    """Mean and callable share by tumbling window; rows later than `late` are left out and their state is dropped."""
    w = stream.withWatermark("ts", late).groupBy(*keys, F.window("ts", size).alias("w"))
    out = w.agg(F.avg(value).alias("mean"), F.count_if(F.col(value) >= callable_at).alias("callable"), F.count(value).alias("n"))
    return out.select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "mean", (F.col("callable") / F.col("n")).alias("callable"), "n")


def complete_groups(stream: DataFrame, key: str, expected: str) -> DataFrame:
    """(key, n) once for each group, as soon as it has as many rows as its `expected` column says.

    The state of a group is one number; it is marked as given when the group is complete.
    """

    def step(k: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, given = state.get if state.exists else (0, False)
        want = None
        for p in parts:
            seen += len(p)
            want = int(p[expected].max()) if len(p) else want
        if want is not None and seen >= want and not given:
            given = True
            yield pd.DataFrame({key: [k[0]], "n": [seen]})
        state.update((seen, given))

    kind = stream.schema[key].dataType.simpleString()
    return stream.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, n long", "seen long, given boolean", "append", GroupStateTimeout.NoTimeout)
