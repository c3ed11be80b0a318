"""Session builder and the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SHARED = "strandwise.shared.dir"


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, app: str = "strandwise") -> SparkSession:
    """A local session for tests and benches: UTC, AQE on."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset a temporary one for local masters and an error for others."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_SHARED, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="strandwise-")
        spark.conf.set(_SHARED, root)
    return root.rstrip("/")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again.

    It cuts the lineage: what comes after survives the loss of any executor and never runs the plan above twice.
    """
    path = f"{_own_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/strandwise/{spark.sparkContext.applicationId}"


def drop_staged(spark: SparkSession) -> None:
    """Remove the application's staged tables, once no DataFrame that reads them is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
