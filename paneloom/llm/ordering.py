"""Running totals and positions along a global order, at any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paneloom.store import materialise


def running_totals(df: DataFrame, by: Sequence[str], order: Sequence[str], size: str, before: str = "before") -> DataFrame:
    """Add ``before``: the sum of ``size`` over the earlier rows of the same ``by`` group.

    Rows are range-partitioned by (by, order) and stored, so that the borders cannot move; sums
    run inside a partition, and a table of one row per partition and group carries them on. A
    group of any size is spread over many tasks. ``order`` should end in a column that tells all
    rows apart; rows equal in it stay in one partition.
    """
    by, order = list(by), list(order)
    pieces = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialise(
        df.repartitionByRange(pieces, *by, *order).withColumn("_part", F.spark_partition_id()), "ordered"
    )
    earlier = Window.partitionBy("_part", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    carried = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    names = {c: f"_of_{c}" for c in ["_part", *by]}
    totals = (
        placed.groupBy("_part", *by)
        .agg(F.sum(size).alias("_total"))
        .withColumn("_carried", F.coalesce(F.sum("_total").over(carried), F.lit(0)))
        .drop("_total")
        .withColumnsRenamed(names)
    )
    summed = placed.withColumn(before, F.coalesce(F.sum(size).over(earlier), F.lit(0)))
    matches = [F.col(c).eqNullSafe(F.col(other)) for c, other in names.items()]
    return (
        summed.join(totals, matches, "left")
        .withColumn(before, F.col(before) + F.col("_carried"))
        .drop("_part", "_carried", *names.values())
    )
