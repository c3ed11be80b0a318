from pyspark.sql import functions as F

from strandwise.streaming.events import complete_groups, keep, read_events, windowed_depth


def drain(stream, name, mode):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return stream.sparkSession.table(name).collect()


def test_streams(spark, tmp_path):
    rows = [(k, i, 3, f"2024-01-0{1 + i} 00:00:00") for k in (1, 2) for i in range(3 if k == 1 else 2)]
    df = spark.createDataFrame(rows, "k long, value long, expected int, at string").withColumn("ts", F.col("at").cast("timestamp_ntz")).drop("at")
    df.repartition(3).write.parquet(f"{tmp_path}/e")
    source = lambda: read_events(spark, f"{tmp_path}/e", df.schema.simpleString()[7:-1].replace(":", " "))
    assert len(drain(keep(source(), F.col("value") > 0), "kept", "append")) == 3
    assert [tuple(r) for r in drain(complete_groups(source(), "k", "expected"), "complete", "append")] == [(1, 3)]
    w = drain(windowed_depth(source(), ["k"], "value", callable_at=1), "windows", "complete")
    assert sum(r["n"] for r in w) == 5 and {r["callable"] for r in w if r["start"].day == 2} == {1.0}
