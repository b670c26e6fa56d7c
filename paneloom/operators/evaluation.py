"""Regression metrics, naive baselines and model selection as aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneloom.functions import aggregates as A
from paneloom.functions import scalars as S

METRICS = ["mae", "rmse", "r2"]


def regression_metrics(predictions: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE and R2 in one aggregation, for all models at once when ``by`` names the model."""
    pair = (F.col(actual), F.col(predicted))
    return predictions.groupBy(*by).agg(
        A.mean_absolute_error(*pair).alias("mae"),
        A.root_mean_squared_error(*pair).alias("rmse"),
        A.r_squared(*pair).alias("r2"),
    )


def persistence_baseline(test: DataFrame, level: str = "a") -> DataFrame:
    """Next value = current value."""
    return test.withColumn("prediction", F.col(level))


def previous_change(train: DataFrame, change: str, target: str) -> Column:
    """Next change = last change; where that is missing, the training mean of the target."""
    return F.coalesce(F.col(change), train.agg(F.avg(target)).scalar())


def previous_change_baseline(test: DataFrame, train: DataFrame, change: str, target: str) -> DataFrame:
    return test.withColumn("prediction", previous_change(train, change, target))


def prediction_errors(predictions: DataFrame, actual: str, predicted: str = "prediction") -> DataFrame:
    return predictions.withColumn("error", F.col(predicted) - F.col(actual))


def best_model(metrics: DataFrame, eligible: Column | None = None) -> DataFrame:
    """The lowest-MAE row, ties broken by name; ``eligible`` restricts the candidates.

    The naive baseline is reported beside the fitted models but has nothing to save, so
    callers leave it out of ``eligible``.
    """
    rows = metrics if eligible is None else metrics.where(eligible)
    others = [c for c in metrics.columns if c not in ("mae", "model")]
    best = rows.agg(F.min(F.struct("mae", "model", *others)).alias("_best"))
    return best.where(F.col("_best").isNotNull()).select(*[F.col(f"_best.{c}").alias(c) for c in metrics.columns])


def flag_selected(metrics: DataFrame, eligible: Column, flag: str = "selected_for_scenarios") -> DataFrame:
    """All rows, with the lowest-MAE eligible model flagged."""
    chosen = metrics.where(eligible).agg(F.min_by("model", F.struct("mae", "model"))).scalar()
    return metrics.withColumn(flag, F.coalesce(F.col("model") == chosen, F.lit(False)))


def model_card(metrics: DataFrame, flag: str = "selected_for_scenarios") -> DataFrame:
    """The flagged model; without any flag the lowest-MAE one."""
    preferred = F.struct(~S.parse_flag(F.col(flag)), F.col("mae"), F.col("model"))
    return metrics.agg(F.min_by(F.struct("model", "mae"), preferred).alias("_card")).select("_card.model", "_card.mae")
