"""Group aggregates, trendlines, reshaping for display and top-k reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneloom import roles as R
from paneloom.functions import aggregates as A


def count_min_max(df: DataFrame, category: str, period: str) -> DataFrame:
    return df.groupBy(category).agg(
        F.count("*").alias("row_count"),
        F.min(period).alias("min_period"),
        F.max(period).alias("max_period"),
    )


def group_average(df: DataFrame, group: str, metric: str, digits: int = 2) -> DataFrame:
    """Unweighted mean per group, ordered by the rounded mean (as shown), then the group."""
    return (
        df.groupBy(group)
        .agg(F.round(F.avg(metric), digits).alias(f"avg_{metric}"))
        .orderBy(F.desc_nulls_first(f"avg_{metric}"), F.asc(group))
    )


def group_range(df: DataFrame, metric: str) -> DataFrame:
    """Entities, mean, minimum and maximum per (group, period)."""
    return df.groupBy(R.GROUP, R.PERIOD).agg(
        F.count_distinct(R.ENTITY).alias("entities"),
        F.avg(metric).alias(f"avg_{metric}"),
        F.min(metric).alias(f"min_{metric}"),
        F.max(metric).alias(f"max_{metric}"),
    )


def group_summary(panel: DataFrame, keys_are_unique: bool = False) -> DataFrame:
    """Entities, three means and the correlation of b with a per (group, period).

    Where (entity, period) is known to be unique, counting rows equals counting distinct
    entities and saves the extra shuffle by entity.
    """
    entities = F.count(R.ENTITY) if keys_are_unique else F.count_distinct(R.ENTITY)
    return panel.groupBy(R.GROUP, R.PERIOD).agg(
        entities.alias("entities"),
        F.avg(R.METRIC_A).alias("avg_a"),
        F.avg(R.METRIC_B).alias("avg_b"),
        F.avg(R.METRIC_B2).alias("avg_b2"),
        A.correlation(F.col(R.METRIC_B), F.col(R.METRIC_A)).alias("corr_b_a"),
    )


def trendline(df: DataFrame, group: Sequence[str], y: str, x: str) -> DataFrame:
    """Ordinary least squares of y on x in each group, by partial aggregation."""
    fit = (F.col(y), F.col(x))
    return df.groupBy(*group).agg(
        A.ols_count(*fit).alias("n"),
        A.ols_slope(*fit).alias("slope"),
        A.ols_intercept(*fit).alias("intercept"),
        A.ols_r2(*fit).alias("r2"),
    )


def kpi_aggregates() -> list[Column]:
    return [
        F.max(R.PERIOD).alias("latest_period"),
        F.count_distinct(R.ENTITY).alias("entities"),
        F.avg(R.METRIC_A).alias("avg_a"),
        F.avg(R.METRIC_B).alias("avg_b"),
    ]


def kpis(df: DataFrame) -> DataFrame:
    return df.agg(*kpi_aggregates())


def unpivot_metrics(df: DataFrame, keep: Sequence[str], labels: Mapping[str, str]) -> DataFrame:
    """Wide metric columns to (metric label, value) rows; NULL values are kept."""
    pair = F.explode(
        F.array(*[F.struct(F.lit(t).alias("metric"), F.col(c).cast("double").alias("value")) for c, t in labels.items()])
    )
    return df.select(*keep, pair.alias("_pair")).select(*keep, "_pair.metric", "_pair.value")


def top_k(
    df: DataFrame, metric: str, k: int, tie_break: Sequence[str], nulls_first: bool = False
) -> DataFrame:
    """Largest k rows. Spark keeps k rows per task and merges them; nothing is sorted whole."""
    order = F.desc_nulls_first(metric) if nulls_first else F.desc_nulls_last(metric)
    return df.orderBy(order, *[F.asc(c) for c in tie_break]).limit(k)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def scenario_counts(forecast: DataFrame) -> DataFrame:
    return forecast.groupBy("scenario").agg(
        F.count("*").alias("row_count"),
        F.count_distinct(R.ENTITY).alias("entities"),
        F.min("forecast_period").alias("min_period"),
        F.max("forecast_period").alias("max_period"),
    )


def rounded(df: DataFrame, digits: Mapping[str, int], half_even: bool = True) -> DataFrame:
    """Display rounding; half-even as data frames print it, half-up as SQL ROUND does."""
    rounding = F.bround if half_even else F.round
    return df.withColumns({c: rounding(F.col(c), d) for c, d in digits.items()})


def fill_with(df: DataFrame, column: str, scalar: Column, output: str) -> DataFrame:
    return df.withColumn(output, F.coalesce(F.col(column), scalar))
