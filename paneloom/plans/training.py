"""Train, compare, select, save; and forecast with what was saved."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneloom import roles as R
from paneloom.operators import evaluation as E
from paneloom.operators import features as FE
from paneloom.operators import models as M
from paneloom.operators import scenario as SC
from paneloom.operators.forest import forecast_with_forest
from paneloom.operators.linear import LinearModel
from paneloom.store import deal, materialise

LINEAR = ["linear_regression", "ridge_regression"]
NAIVE_CHANGE, NAIVE_LEVEL = "naive_previous_3yr_change", "naive_baseline"


@dataclass
class Training:
    models: dict[str, M.Model]
    metrics: DataFrame
    predictions: DataFrame
    selected: str


def train_change_model(
    features: DataFrame,
    last_train_period: int,
    trees: int = 300,
    depth: int = 10,
    partitions: int = 8,
    max_levels: int | None = None,
    buffer_mb: int = 48,
) -> Training:
    """Three-period-change model: the lowest-MAE *linear* candidate is flagged for scenarios.

    ``partitions`` and ``max_levels`` are those of ``models.fit_all``, ``buffer_mb`` that of ``models.forest``.
    """
    numeric, target = FE.CHANGE_NUMERIC, FE.CHANGE_TARGET
    rows = materialise(FE.training_rows(features, numeric, target), "training")
    train, test = FE.time_split(rows, last_train_period)
    estimators = {
        "linear_regression": M.ols(target),
        "ridge_regression": M.ridge(target),
        "random_forest": M.forest(target, trees, depth, buffer_mb=buffer_mb),
    }
    models = M.fit_all(estimators, train, numeric, partitions, max_levels)
    naive = E.previous_change(train, "a_change_3", target)
    scored = materialise(M.predictions_long(models, test, {NAIVE_CHANGE: naive}), "predictions")
    family = F.when(F.col("model") == NAIVE_CHANGE, F.lit("baseline")).otherwise(F.lit("ml"))
    both = E.regression_metrics(scored, target, "prediction", ["model"]).select("model", family.alias("model_family"), *E.METRICS)
    both = materialise(both, "metrics")
    long = scored.where(F.col("model") != NAIVE_CHANGE)
    metrics = E.flag_selected(both, F.col("model").isin(LINEAR))
    selected = metrics.where("selected_for_scenarios").first()["model"]
    predictions = E.prediction_errors(long, target).select(
        R.ENTITY, R.NAME, R.PERIOD, "a", "b", target, "model", "prediction", "error"
    )
    return Training(models, metrics, predictions, selected)


def train_level_model(
    features: DataFrame,
    last_train_period: int,
    trees: int = 300,
    depth: int = 12,
    partitions: int = 8,
    max_levels: int | None = None,
    buffer_mb: int = 48,
) -> Training:
    """Next-level model: the lowest-MAE fitted candidate wins; the baseline is only reported.

    ``partitions`` and ``max_levels`` are those of ``models.fit_all``, ``buffer_mb`` that of ``models.forest``.
    """
    numeric, target = FE.LEVEL_NUMERIC, FE.LEVEL_TARGET
    rows = materialise(FE.training_rows(features, numeric, target), "training")
    train, test = FE.time_split(rows, last_train_period)
    estimators = {"linear_regression": M.ols(target), "random_forest": M.forest(target, trees, depth, buffer_mb=buffer_mb)}
    models = M.fit_all(estimators, train, numeric, partitions, max_levels)
    long = materialise(M.predictions_long(models, test, {NAIVE_LEVEL: F.col("a")}), "predictions")
    metrics = materialise(E.regression_metrics(long, target, "prediction", ["model"]).select("model", *E.METRICS), "metrics")
    selected = E.best_model(metrics, F.col("model") != NAIVE_LEVEL).first()["model"]
    predictions = E.prediction_errors(long.where(F.col("model") == selected), target).select(
        R.ENTITY, R.NAME, R.PERIOD, R.GROUP, target, "prediction", "error"
    )
    return Training(models, metrics.orderBy("mae", "model"), predictions, selected)


def forecast(
    panel: DataFrame,
    model: M.Model,
    model_name: str,
    predicts: str,
    first_period: int,
    end_period: int,
    scenarios: Mapping[str, float] = SC.SCENARIOS,
    partitions: int | None = None,
) -> DataFrame:
    """Scenario forecast with a fitted model, all periods of an entity in one pass: a fold over its row, or a walk of the forest.

    Both run in ``partitions`` tasks, by default as many as the session's shuffles have.

    Raises ``ContractError`` when nothing falls into the reporting window.
    """
    state = materialise(SC.latest_state(SC.forecast_history(panel)), "state")
    state = deal(state, partitions)
    if isinstance(model, LinearModel):
        rolled = SC.roll_forward(state, end_period, model.form(), predicts, scenarios, group_effects=model.effects)
    else:
        rolled = materialise(forecast_with_forest(model, state, end_period, predicts, scenarios), "forecast")  # else walked again to see that there are rows
    out = SC.require_forecast(SC.emit_window(rolled, first_period))
    if predicts == "change":
        out = out.withColumn("model_name", F.lit(model_name)).withColumn("model_type", F.lit("sugar_sensitivity_model"))
    return out
