"""Panel construction, snapshots, span changes and row-to-row changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from paneloom import roles as R


def by_entity() -> WindowSpec:
    return Window.partitionBy(R.ENTITY).orderBy(R.PERIOD)


def panel_join(observations: DataFrame, supply: DataFrame) -> DataFrame:
    """Inner join of the two facts on (entity, period); unmatched rows of either side vanish."""
    return observations.join(supply, R.KEY, "inner")


def period_bounds(df: DataFrame) -> DataFrame:
    return df.agg(F.min(R.PERIOD).alias("start_period"), F.max(R.PERIOD).alias("end_period"))


def latest_period(df: DataFrame) -> Column:
    """Uncorrelated scalar subquery; only the period column is read for it."""
    return df.select(R.PERIOD).agg(F.max(R.PERIOD)).scalar()


def first_period(df: DataFrame) -> Column:
    return df.select(R.PERIOD).agg(F.min(R.PERIOD)).scalar()


def latest_snapshot(df: DataFrame, within: DataFrame | None = None) -> DataFrame:
    """Rows of the last period of ``within`` (default: of the frame itself).

    The choice of ``within`` is the choice between the different meanings of "latest": the
    aggregate category, all categories, or the joined panel.
    """
    return df.where(F.col(R.PERIOD) == latest_period(df if within is None else within))


def add_changes(panel: DataFrame, metrics: Sequence[str] = (R.METRIC_A, R.METRIC_B)) -> DataFrame:
    """Difference to the entity's previous row for each metric; one shuffle, one sort for all."""
    return panel.withColumns({f"{m}_change": F.col(m) - F.lag(m).over(by_entity()) for m in metrics})


def row_offsets(panel: DataFrame, outputs: dict[str, tuple[str, int]]) -> DataFrame:
    """``{output: (metric, k)}``: value k rows back (k > 0) or ahead (k < 0) within the entity."""
    return panel.withColumns({out: F.lag(m, k).over(by_entity()) for out, (m, k) in outputs.items()})


def calendar_offsets(panel: DataFrame, outputs: dict[str, tuple[str, int]]) -> DataFrame:
    """Like ``row_offsets`` but for exactly period - k; a missing period gives NULL.

    A RANGE frame of the single value -k is an exact-period lookup and shares the sort of
    every other window over the entity. (entity, period) is unique, so ``max`` just reads it.
    """
    return panel.withColumns(
        {out: F.max(m).over(by_entity().rangeBetween(-k, -k)) for out, (m, k) in outputs.items()}
    )


def span_change(
    panel: DataFrame,
    metrics: Sequence[str],
    attributes: Sequence[str] = (),
    start: int | Column | None = None,
    end: int | Column | None = None,
) -> DataFrame:
    """Value at the first and the last period, and their difference, per entity.

    Bounds are global unless given, and an entity must have a row at both. One filtered pass
    and one aggregation; the two period slices are never joined to each other.
    """
    lo = first_period(panel) if start is None else (F.lit(start) if isinstance(start, int) else start)
    hi = latest_period(panel) if end is None else (F.lit(end) if isinstance(end, int) else end)
    ends = panel.select(
        R.ENTITY, R.PERIOD, *attributes, *metrics, lo.alias("start_period"), hi.alias("end_period")
    ).where((F.col(R.PERIOD) == F.col("start_period")) | (F.col(R.PERIOD) == F.col("end_period")))
    at_lo = F.col(R.PERIOD) == F.col("start_period")
    at_hi = F.col(R.PERIOD) == F.col("end_period")
    cells = [F.max("start_period").alias("start_period"), F.max("end_period").alias("end_period")]
    for m in metrics:
        cells.append(F.max(F.when(at_lo, F.col(m))).alias(f"{m}_start"))
        cells.append(F.max(F.when(at_hi, F.col(m))).alias(f"{m}_latest"))
    cells += [F.max(F.when(at_hi, F.col(c))).alias(c) for c in attributes]
    both = ends.groupBy(R.ENTITY).agg(
        *cells, F.count_if(at_lo).alias("_at_lo"), F.count_if(at_hi).alias("_at_hi")
    )
    changed = both.where((F.col("_at_lo") > 0) & (F.col("_at_hi") > 0)).drop("_at_lo", "_at_hi")
    return changed.withColumns(
        {f"{m}_span_change": F.col(f"{m}_latest") - F.col(f"{m}_start") for m in metrics}
    )


def slice_join(panel: DataFrame, metric: str, start: int | Column, end: int | Column) -> DataFrame:
    """The two-slice form: rows at ``start`` joined by entity to rows at ``end``."""
    lo = F.lit(start) if isinstance(start, int) else start
    hi = F.lit(end) if isinstance(end, int) else end
    left = panel.where(F.col(R.PERIOD) == lo).select(R.ENTITY, F.col(metric).alias(f"{metric}_start"))
    right = panel.where(F.col(R.PERIOD) == hi).select(R.ENTITY, F.col(metric).alias(f"{metric}_latest"))
    return right.join(left, R.ENTITY).withColumn(
        f"{metric}_span_change", F.col(f"{metric}_latest") - F.col(f"{metric}_start")
    )


def category_gap(
    observations: DataFrame, first: str, second: str, metric: str, attributes: Sequence[str], period: Column
) -> DataFrame:
    """``first`` minus ``second`` category per entity at ``period``, entities having both.

    One conditional aggregate in place of a self join: the fact is scanned and shuffled once.
    """
    is_first, is_second = F.col(R.CATEGORY) == first, F.col(R.CATEGORY) == second
    rows = observations.where(F.col(R.CATEGORY).isin(first, second)).where(F.col(R.PERIOD) == period)
    sides = rows.groupBy(R.ENTITY, R.PERIOD).agg(
        F.max(F.when(is_first, F.col(metric))).alias("first_value"),
        F.max(F.when(is_second, F.col(metric))).alias("second_value"),
        *[F.max(F.when(is_first, F.col(c))).alias(c) for c in attributes],
        F.count_if(is_first).alias("_first"),
        F.count_if(is_second).alias("_second"),
    )
    return (
        sides.where((F.col("_first") > 0) & (F.col("_second") > 0))
        .drop("_first", "_second")
        .withColumn("gap", F.col("first_value") - F.col("second_value"))
    )


def entity_series(panel: DataFrame, entity, columns: Sequence[str]) -> DataFrame:
    """One entity's rows in period order; the entity (a value or a scalar column) filters the scan."""
    return panel.where(F.col(R.ENTITY) == F.lit(entity)).select(R.PERIOD, *columns).orderBy(R.PERIOD)
