"""Shared scratch storage: where lineage is cut and intermediate tables are written.

A table written to the cluster's shared folder survives the loss of any executor, keeps its
columnar layout (so later readers still prune columns and push filters), and gives the
optimiser an exact size, which is what decides about broadcasting it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a fresh temporary one only on a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="paneloom-")
    return _local_dirs[context.applicationId]


def new_path(spark: SparkSession, label: str) -> str:
    """A path nobody has written to yet."""
    return f"{shared_dir(spark)}/paneloom/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> None:
    """Delete what this application wrote to the shared folder; frames read from it end here."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/paneloom/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, label: str = "table", compression: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back; for inputs that several passes consume.

    ``compression`` names a codec other than the session's, for wide tables that are read once or twice.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    writer = df.write.mode("errorifexists")
    (writer.option("compression", compression) if compression else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def deal(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal the rows evenly over ``partitions`` tasks, by default as many as the session's shuffles have.

    For compute-heavy steps over short rows that may lie in few files, such as one row of state
    per entity. The count is a setting: neither the machine nor the input changes it.
    """
    return df.repartition(partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
