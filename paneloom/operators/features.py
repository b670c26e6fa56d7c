"""Lag/lead feature tables, time split and the scaling/one-hot steps in SQL form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paneloom import roles as R
from paneloom.operators.clean import complete_rows
from paneloom.operators.panel import calendar_offsets, row_offsets
from paneloom.operators.quality import ContractError
from paneloom.store import materialise

BASE = [R.ENTITY, R.NAME, R.PERIOD, R.METRIC_A, R.METRIC_B, R.METRIC_B2, R.GROUP, R.GROUP_CODE]

LEVEL_NUMERIC = [
    "period", "a", "a_lag_1", "a_lag_2", "a_lag_3", "a_change_1", "a_change_3",
    "b", "b2", "b_lag_1", "b_lag_3", "b_change_1", "b_change_3",
]
LEVEL_TARGET = "target_a_next"

CHANGE_NUMERIC = [
    "period", "a", "a_change_1", "a_change_3",
    "b", "b2", "b_lag_1", "b_lag_3", "b_change_1", "b_change_3",
]
CHANGE_TARGET = "target_a_change_3"


def _offsets(offset: str):
    return {"row": row_offsets, "calendar": calendar_offsets}[offset]


def _add_changes(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {f"{m}_change_{k}": F.col(m) - F.col(f"{m}_lag_{k}") for m in (R.METRIC_A, R.METRIC_B) for k in (1, 3)}
    )


def next_period_features(panel: DataFrame, offset: str = "row") -> DataFrame:
    """Lags 1-3 of a, lags 1 and 3 of b, their changes, and the next a as target.

    Rows with missing metrics take part in the lagging.
    """
    shifts = {
        "a_lag_1": ("a", 1), "a_lag_2": ("a", 2), "a_lag_3": ("a", 3),
        "b_lag_1": ("b", 1), "b_lag_3": ("b", 3), LEVEL_TARGET: ("a", -1),
    }
    lagged = _add_changes(_offsets(offset)(panel.select(*BASE), shifts))
    return lagged.select(
        R.ENTITY, R.NAME, R.PERIOD, R.GROUP, R.GROUP_CODE,
        "a", "a_lag_1", "a_lag_2", "a_lag_3", "b", "b2", "b_lag_1", "b_lag_3",
        "a_change_1", "a_change_3", "b_change_1", "b_change_3", LEVEL_TARGET,
    )


def change_features(panel: DataFrame, offset: str = "row") -> DataFrame:
    """Lags 1 and 3, their changes, and the change of a three rows ahead as target.

    Rows missing any metric are dropped *before* lagging, so an offset counts complete rows.
    """
    complete = panel.select(*BASE).dropna(subset=["a", "b", "b2"])
    shifts = {
        "a_lag_1": ("a", 1), "a_lag_3": ("a", 3),
        "b_lag_1": ("b", 1), "b_lag_3": ("b", 3), "a_future_3": ("a", -3),
    }
    lagged = _add_changes(_offsets(offset)(complete, shifts))
    return lagged.select(
        R.ENTITY, R.NAME, R.PERIOD, "a", "a_lag_1", "a_lag_3", "a_change_1", "a_change_3",
        "b", "b2", "b_lag_1", "b_lag_3", "b_change_1", "b_change_3",
        R.GROUP, R.GROUP_CODE, "a_future_3", (F.col("a_future_3") - F.col("a")).alias(CHANGE_TARGET),
    )


def training_rows(features: DataFrame, numeric: Sequence[str], target: str) -> DataFrame:
    """Rows with every feature, the group and the target present."""
    return complete_rows(features, [*numeric, R.GROUP, target])


def time_split(rows: DataFrame, last_train_period: int) -> tuple[DataFrame, DataFrame]:
    """Rows up to the cut for training, later ones for testing; neither may be empty."""
    train = rows.where(F.col(R.PERIOD) <= last_train_period)
    test = rows.where(F.col(R.PERIOD) > last_train_period)
    if train.isEmpty() or test.isEmpty():
        raise ContractError(f"time split at {last_train_period} leaves an empty side")
    return train, test


def split_counts(rows: DataFrame, last_train_period) -> DataFrame:
    part = F.when(F.col(R.PERIOD) <= last_train_period, F.lit("train")).otherwise(F.lit("test"))
    return rows.groupBy(part.alias("part")).agg(
        F.count("*").alias("row_count"),
        F.min(R.PERIOD).alias("min_period"),
        F.max(R.PERIOD).alias("max_period"),
    )


def z_scores(df: DataFrame, columns: Sequence[str], fitted_on: DataFrame) -> DataFrame:
    """Population z-scores with the moments of ``fitted_on``; constant columns are only centred.

    The moments come from one aggregate and return as a one-row scalar subquery, so no
    window gathers the table in one task.
    """
    moments = fitted_on.agg(
        F.struct(
            *[F.avg(c).alias(f"mean_{c}") for c in columns],
            *[F.stddev_pop(c).alias(f"sd_{c}") for c in columns],
        ).alias("moments")
    ).scalar()
    with_moments = df.withColumn("_moments", moments)
    scaled = {}
    for c in columns:
        sd = F.col(f"_moments.sd_{c}")
        scaled[f"z_{c}"] = (F.col(c) - F.col(f"_moments.mean_{c}")) / F.when(sd == 0, F.lit(1.0)).otherwise(sd)
    return with_moments.withColumns(scaled).drop("_moments")


def group_levels(df: DataFrame, column: str = R.GROUP, limit: int = 10_000) -> list[str]:
    """The distinct group names, sorted; refuses to bring more than ``limit`` to the driver."""
    levels = [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()]
    if len(levels) > limit:
        raise ContractError(f"{column} has more than {limit} levels; too many for one-hot columns")
    return sorted(levels)


def group_index(df: DataFrame, column: str = R.GROUP) -> DataFrame:
    """(level, slot): the distinct groups numbered from 0 in their order, as a stored table of any size.

    Range-partitioned by level; numbers run on from one partition to the next by a table of one row each.
    """
    pieces = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = df.select(F.col(column).alias("level")).where("level is not null").distinct()
    placed = materialise(distinct.repartitionByRange(pieces, "level").withColumn("_part", F.spark_partition_id()), "levels")
    before = Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(F.col("_part").alias("_of")).agg(F.count("*").alias("_n"))
    carried = totals.select("_of", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_carried"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy("level")) - 1
    numbered = placed.withColumn("_inside", inside).join(carried, F.col("_part") == F.col("_of"))
    return materialise(numbered.select("level", (F.col("_inside") + F.col("_carried")).alias("slot")), "slots")


def one_hot(df: DataFrame, levels: Sequence[str], column: str = R.GROUP) -> DataFrame:
    """One 0/1 column per level; a level not seen in training is all zeros."""
    return df.withColumns(
        {f"{column}_{level}": F.coalesce((F.col(column) == level).cast("int"), F.lit(0)) for level in levels}
    )
