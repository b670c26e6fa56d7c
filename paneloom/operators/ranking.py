"""Descending ranks over whole snapshots or over the rows of a period, at any size and for any type.

A plain ``RANK() OVER (PARTITION BY period ...)`` sorts a whole period in one task. Here the
distinct values are ranked instead of the rows:

* rows are counted per (group, value), so ties and hot values vanish map-side;
* those counts are range-partitioned by (group, value) and stored, so that the borders cannot
  move; running sums inside a partition and one small table of totals give every value's rank;
* the rank is joined back on (group, value), null-safe, where a hot value's rows may be split.

The metric is compared as it is, never converted: ties share a rank and leave a gap, NULL ranks
first, then NaN. Ranks are bigint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paneloom.store import materialise


def add_ranks(df: DataFrame, ranks: dict[str, str], by: Sequence[str] = ()) -> DataFrame:
    """Add ``{rank column: metric}`` ranks, highest metric first, within each ``by`` group.

    All metrics are counted, ordered and ranked as one table of values. ``df`` is read once for that and
    once for the result; pass a stored table.
    """
    by, metrics = list(by), list(dict.fromkeys(ranks.values()))
    values = _value_ranks(df, metrics, by)
    out = df
    for i, metric in enumerate(metrics):
        named = [name for name, m in ranks.items() if m == metric]
        out = _with_value_ranks(out, values.where(F.col("_metric") == i), i, metric, by, named)
    return out.select(*df.columns, *ranks)


def _value_ranks(df: DataFrame, metrics: list[str], by: list[str]) -> DataFrame:
    """(_metric, _by_0, ..., _value_0, ..., _rank) for the distinct values of every group and metric, stored.

    A row has its metric's value in the column of that number and NULL in the others, so metrics keep their types.
    """
    groups = [f"_by_{i}" for i in range(len(by))]
    columns = [f"_value_{i}" for i in range(len(metrics))]
    kinds = {m: df.schema[m].dataType for m in metrics}
    one = [
        F.struct(F.lit(i).alias("_metric"), *[(F.col(m) if i == j else F.lit(None).cast(kinds[m])).alias(columns[j]) for j, m in enumerate(metrics)])
        for i in range(len(metrics))
    ]
    unpivoted = df.select(*[F.col(c).alias(g) for c, g in zip(by, groups, strict=True)], F.explode(F.array(*one)).alias("_one")).select(*groups, "_one.*")
    counts = unpivoted.groupBy("_metric", *groups, *columns).agg(F.count("*").alias("_rows"))
    pieces = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    descending = [F.desc_nulls_first(c) for c in columns]
    placed = materialise(
        counts.repartitionByRange(pieces, "_metric", *groups, *descending).withColumn("_part", F.spark_partition_id()), "values"
    )
    parts = ["_metric", *groups]
    higher = Window.partitionBy("_part", *parts).orderBy(*descending).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*parts).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        placed.groupBy("_part", *parts).agg(F.sum("_rows").alias("_total"))
        .withColumn("_carried", F.coalesce(F.sum("_total").over(before), F.lit(0))).drop("_total")
        .withColumnsRenamed({c: f"{c}_of" for c in ["_part", *parts]})
    )
    matches = [F.col(c).eqNullSafe(F.col(f"{c}_of")) for c in ["_part", *parts]]
    inside = placed.withColumn("_higher", F.coalesce(F.sum("_rows").over(higher), F.lit(0)))
    ranked = inside.join(totals, matches).select(*parts, *columns, (F.col("_higher") + F.col("_carried") + 1).alias("_rank"))
    return materialise(ranked, "ranks")


def _with_value_ranks(df: DataFrame, values: DataFrame, number: int, metric: str, by: list[str], named: list[str]) -> DataFrame:
    own = values.select(*[F.col(f"_by_{i}").alias(f"_g{i}") for i in range(len(by))], F.col(f"_value_{number}").alias("_value"), "_rank")
    matches = [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(by)]
    joined = df.join(own, [*matches, F.col(metric).eqNullSafe(F.col("_value"))])
    return joined.select(*df.columns, *[F.col("_rank").alias(name) for name in named])
