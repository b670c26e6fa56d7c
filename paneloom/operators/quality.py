"""Contracts, constraints, row accounting and profiling."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ContractError(ValueError):
    """Input does not have the promised shape."""


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    present = set(df.columns)
    return [c for c in required if c not in present]


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Fail before any job starts, naming every missing column."""
    missing = missing_columns(df, required)
    if missing:
        raise ContractError(f"missing required columns {missing}; available columns {df.columns}")
    return df


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail when nothing is left; reads at most one row."""
    if df.isEmpty():
        raise ContractError(f"no rows: {what}")
    return df


def key_violations(df: DataFrame, key: Sequence[str], not_null: Sequence[str] = ()) -> DataFrame:
    """Duplicate keys and NULLs in mandatory columns, one row per offending key.

    Both checks come out of one aggregation, so the rows are shuffled once, after the
    map-side combine: a key that repeats a billion times crosses the network once per task.
    """
    mandatory = list(not_null) or list(key)
    any_null = reduce(lambda x, y: x | y, [F.col(c).isNull() for c in mandatory])
    return (
        df.groupBy(*key)
        .agg(F.count("*").alias("row_count"), F.count_if(any_null).alias("null_count"))
        .where((F.col("row_count") > 1) | (F.col("null_count") > 0))
    )


def require_unique_key(df: DataFrame, key: Sequence[str], not_null: Sequence[str] = ()) -> DataFrame:
    offending = key_violations(df, key, not_null).limit(5).collect()
    if offending:
        raise ContractError(f"key {list(key)} violated, for example by {offending}")
    return df


def load_accounting(raw: DataFrame, kept_when, entity: str, period: str) -> DataFrame:
    """Rows before, after and removed by a filter, and the range of what is kept, in one pass.

    ``raw`` already carries normalised columns; ``kept_when`` is the keep predicate.
    """
    kept = F.coalesce(kept_when, F.lit(False))
    counted = raw.agg(
        F.count("*").alias("rows_before"),
        F.count_if(kept).alias("rows_after"),
        F.count_distinct(F.when(kept, F.col(entity))).alias("entities"),
        F.min(F.when(kept, F.col(period))).alias("min_period"),
        F.max(F.when(kept, F.col(period))).alias("max_period"),
    )
    return counted.withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of every value; NULL is a value of its own."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("row_count"))


def profile_range(df: DataFrame, entity: str, period: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("row_count"),
        F.min(period).alias("min_period"),
        F.max(period).alias("max_period"),
        F.count_distinct(entity).alias("entities"),
    )


def distinct_ends(df: DataFrame, column: str, how_many: int = 20) -> DataFrame:
    """First and last distinct values in sort order; each end is a top-k, never a full sort."""
    values = df.select(F.col(column).alias("value")).where(F.col(column).isNotNull()).distinct()
    head = values.orderBy(F.asc("value")).limit(how_many).withColumn("which_end", F.lit("head"))
    tail = values.orderBy(F.desc("value")).limit(how_many).withColumn("which_end", F.lit("tail"))
    return head.unionByName(tail)


def verify_by_category(df: DataFrame, category: str, period: str) -> DataFrame:
    return df.groupBy(category).agg(
        F.count("*").alias("row_count"),
        F.min(period).alias("min_period"),
        F.max(period).alias("max_period"),
    )


def verify_overall(df: DataFrame, entity: str, period: str) -> DataFrame:
    return profile_range(df, entity, period)
