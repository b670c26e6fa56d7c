"""Candidate models: linear fits with group effects, forests on MLlib, scoring in one pass, model-driven forecast."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import ElementwiseProduct, OneHotEncoder, StandardScaler, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paneloom import roles as R
from paneloom.functions import scalars as S
from paneloom.operators.features import group_index
from paneloom.operators.forest import ForestModel, z_scaling
from paneloom.operators.growth import fit_trees
from paneloom.operators.linear import LeastSquares, LinearModel, fit_least_squares
from paneloom.operators.quality import ContractError
from paneloom.operators.scenario import NEEDED, SCENARIOS, LinearForm, scenario_grid, with_group_effect
from paneloom.store import materialise

Model = LinearModel | ForestModel
#: Groups up to which a forest is fitted: every training row has a number for each, as MLlib bins all features.
FOREST_LEVELS = 10_000


def preprocessing(numeric: Sequence[str], train_rows: int) -> list:
    """z-scores with the population deviation, and one 0/1 slot per group number (``_group_no``).

    MLlib's scaler divides by the sample deviation; the factor sqrt(n/(n-1)) turns that into
    the population one. The slot after the last group's, that of unknown groups, is the one
    the encoder drops, so unknown groups are all zeros and every known group keeps its slot.
    """
    factor = math.sqrt(train_rows / (train_rows - 1)) if train_rows > 1 else 1.0
    return [
        VectorAssembler(inputCols=list(numeric), outputCol="_numeric"),
        StandardScaler(inputCol="_numeric", outputCol="_scaled", withMean=True, withStd=True),
        ElementwiseProduct(
            inputCol="_scaled", outputCol="_z", scalingVec=Vectors.dense([factor] * len(numeric))
        ),
        OneHotEncoder(inputCols=["_group_no"], outputCols=["_group_slots"], dropLast=True, handleInvalid="keep"),
        VectorAssembler(inputCols=["_z", "_group_slots"], outputCol="_features"),
    ]


def ols(target: str) -> LeastSquares:
    """Least squares on features that are exactly collinear (changes, and all group slots)."""
    return LeastSquares(target)


def ridge(target: str, alpha: float = 1.0) -> LeastSquares:
    """Penalty ``alpha * |w|^2`` beside the *sum* of squared residuals."""
    return LeastSquares(target, alpha)


def forest(
    target: str, trees: int = 300, depth: int = 10, seed: int = 42, buffer_mb: int = 48
) -> RandomForestRegressor:
    """All features at every split. The level model's default depth is 12, the change model's 10.

    ``buffer_mb`` bounds the split statistics a task holds; with less of it a level of the trees takes
    more passes and comes out the same.
    """
    return RandomForestRegressor(
        featuresCol="_features", labelCol=target, predictionCol="prediction", numTrees=trees, maxDepth=depth,
        featureSubsetStrategy="all", seed=seed, maxMemoryInMB=buffer_mb,
    )


def in_fixed_order(train: DataFrame, partitions: int, key: Sequence[str] = R.KEY) -> DataFrame:
    """The same rows in the same partitions and order, however ``train`` arrives.

    A forest draws its bags with one seed per partition, along the rows of the partition. Hashing the
    unique key into a given number of partitions and sorting each makes the bags a property of the rows.
    """
    return train.repartition(partitions, *key).sortWithinPartitions(*key)


def fit_all(
    estimators: Mapping[str, LeastSquares | RandomForestRegressor],
    train: DataFrame,
    numeric: Sequence[str],
    partitions: int = 8,
    max_levels: int | None = None,
) -> dict[str, Model]:
    """Fit every candidate; the linear ones share their sums, the forests their preprocessing.

    ``partitions`` is the number of partitions a forest is fitted in, at every size of the table: it is
    part of the model, like the seed, so that machines with other core counts fit the same trees. Large
    tables want a larger number, about one for each 128 MB of training rows. A linear fit takes any
    number of groups; a forest holds a slot per group in every row it trains on, and more than
    ``FOREST_LEVELS`` are an error. ``max_levels`` is a lower limit, for all candidates.
    """
    linear = {n: e for n, e in estimators.items() if isinstance(e, LeastSquares)}
    forests = {n: e for n, e in estimators.items() if n not in linear}
    levels = group_index(train) if forests or max_levels is not None else None
    if levels is not None:
        n_levels, limit = levels.count(), FOREST_LEVELS if max_levels is None else max_levels
        if n_levels > limit:
            raise ContractError(f"{R.GROUP} has {n_levels}, more than {limit} levels; too many for slots")
    models: dict[str, Model] = dict(fit_least_squares(linear, train, numeric)) if linear else {}
    if forests:
        known = ForestModel(tuple(numeric), levels, n_levels, None, None)
        slotted = known.with_slot(train)
        n_rows = train.count()
        prepared = Pipeline(stages=preprocessing(numeric, n_rows)).fit(slotted)
        for name, estimator in forests.items():
            wanted = slotted.select(*dict.fromkeys([*R.KEY, *numeric, estimator.getLabelCol(), "_group_no"]))
            inputs = in_fixed_order(wanted, partitions)
            fitted = fit_trees(estimator, inputs, numeric, n_levels, n_rows, *z_scaling(prepared))
            if fitted is None:
                fitted = estimator.fit(prepared.transform(inputs).select("_features", estimator.getLabelCol()))
            models[name] = ForestModel(tuple(numeric), levels, n_levels, prepared, fitted)
    return {name: models[name] for name in estimators}


def fit(estimator, train: DataFrame, numeric: Sequence[str], partitions: int = 8) -> Model:
    return fit_all({"model": estimator}, train, numeric, partitions)["model"]


def predict(model: Model, rows: DataFrame) -> DataFrame:
    """Rows plus ``prediction``."""
    if isinstance(model, ForestModel):
        return model.walked(model.with_slot(rows), "prediction").select(*rows.columns, "prediction")
    return model.transform(rows).select(*rows.columns, "prediction")


def predictions_long(models: Mapping[str, Model], test: DataFrame, others: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per (model, test row), from one reading of the test rows.

    Every model adds a column, linear ones after a join with their small table of effects, forests by a walk
    of their nodes; ``others`` are predictions that are columns already. The columns are then
    unpivoted in place.
    """
    scored, names, slots = test, {}, None
    for i, (name, model) in enumerate(models.items()):
        names[name] = f"_p{i}"
        if isinstance(model, LinearModel):
            scored = with_group_effect(scored, model.effects, model.group, "_effect")
            scored = scored.withColumn(names[name], model.without_groups(F.col) + F.col("_effect")).drop("_effect")
    for name, model in models.items():
        if isinstance(model, ForestModel):
            if slots is not model.levels:  # models fitted together share them
                scored, slots = model.with_slot(scored.drop("_group_no")), model.levels
            scored = model.walked(scored, names[name])
    for i, (name, value) in enumerate((others or {}).items()):
        names[name] = f"_o{i}"
        scored = scored.withColumn(names[name], value)
    pairs = F.array(*[F.struct(F.lit(n).alias("model"), F.col(c).alias("prediction")) for n, c in names.items()])
    return scored.withColumn("_scored", F.explode(pairs)).select(*test.columns, "_scored.prediction", "_scored.model")


def linear_form(model: LinearModel, numeric: Sequence[str], limit: int = 10_000) -> LinearForm:
    """The fitted model as one expression, its group effects (``limit`` at most) included."""
    effects = {r.level: r.effect for r in model.effects.limit(limit + 1).collect()}
    if len(effects) > limit:
        raise ContractError(f"more than {limit} groups; join the table of effects instead")
    return LinearForm(model.intercept, {n: model.weights[n] for n in numeric}, effects)


def save_model(model: Model | PipelineModel, folder: str) -> str:
    """Write a model to a new folder; returns its kind, which ``load_model`` needs."""
    if isinstance(model, LinearModel):
        about = [(model.intercept, list(model.numeric), [float(model.weights[n]) for n in model.numeric], model.group)]
        model.effects.write.parquet(f"{folder}/effects")
        _one_row(model.effects, about, _LINEAR).write.parquet(f"{folder}/form")
        return "linear"
    if isinstance(model, ForestModel):
        model.levels.write.parquet(f"{folder}/levels")
        model.pipeline.write().save(f"{folder}/pipeline")
        _one_row(model.levels, [(list(model.numeric), model.n_levels, model.group)], _FOREST).write.parquet(f"{folder}/form")
        return "forest"
    model.write().save(f"{folder}/pipeline")
    return "pipeline"


def load_model(spark: SparkSession, folder: str, kind: str) -> Model | PipelineModel:
    if kind == "linear":
        form = spark.read.schema(_LINEAR).parquet(f"{folder}/form").first()
        weights = dict(zip(form.numeric, form.weights, strict=True))
        return LinearModel(tuple(form.numeric), form.intercept, weights, spark.read.parquet(f"{folder}/effects"), form.group)
    pipeline = PipelineModel.load(f"{folder}/pipeline")
    if kind == "pipeline":
        return pipeline
    form = spark.read.schema(_FOREST).parquet(f"{folder}/form").first()
    *stages, trees = pipeline.stages
    return ForestModel(tuple(form.numeric), spark.read.parquet(f"{folder}/levels"), form.n_levels, PipelineModel(stages=stages), trees, form.group)


_LINEAR = "intercept double, numeric array<string>, weights array<double>, `group` string"
_FOREST = "numeric array<string>, n_levels bigint, `group` string"


def _one_row(beside: DataFrame, row: list[tuple], schema: str) -> DataFrame:
    return beside.sparkSession.createDataFrame(row, schema).coalesce(1)


def forecast_with_model(
    model: Model,
    state: DataFrame,
    end_period: int,
    predicts: str,
    scenarios: Mapping[str, float] = SCENARIOS,
    horizon: int = 3,
    low: float = 0.0,
    high: float = 100.0,
) -> DataFrame:
    """The recursive forecast for any fitted model, step by step.

    One ``transform`` per calendar step over all entities and scenarios still running; the
    state is written out between steps, so the plan stays short. At most end - first steps.
    """
    needed = list(NEEDED[predicts])
    live = state.where(F.col("last_period") < end_period).dropna(subset=needed)
    first = live.agg(F.min("last_period")).first()[0]
    if first is None:
        raise ContractError("no entity has periods left to forecast")
    running = scenario_grid(live, scenarios).withColumns(
        {"b_latest": F.col("b_t0"), "b2_latest": F.col("b2_t0")}
    )
    waiting = materialise(running, "state")
    active, steps = None, []
    for period in range(first + 1, end_period + 1):
        entering = waiting.where(F.col("last_period") == period - 1)
        active = entering if active is None else active.unionByName(entering)
        moved = _one_step(model, active.dropna(subset=needed), period, end_period, predicts, horizon, low, high)
        moved = materialise(moved, "step")
        steps.append(moved)
        active = moved.select(*waiting.columns)
    out = steps[0]
    for s in steps[1:]:
        out = out.unionByName(s)
    columns = [R.ENTITY, R.NAME, R.GROUP, R.GROUP_CODE, "scenario", "total_change", "forecast_period", "forecast_a",
               "input_period", "predicted_change", "annualised_change", "b_assumption", "b2_assumption"]
    rows = out.select(*columns)
    return rows if predicts == "change" else rows.drop("predicted_change", "annualised_change")


def _one_step(model, active, period, end_period, predicts, horizon, low, high) -> DataFrame:
    inputs = active.withColumns(
        {
            R.PERIOD: F.lit(period - 1),
            "a": F.col("a_t0"), "a_lag_1": F.col("a_t1"), "a_lag_2": F.col("a_t2"), "a_lag_3": F.col("a_t3"),
            "a_change_1": F.col("a_t0") - F.col("a_t1"), "a_change_3": F.col("a_t0") - F.col("a_t3"),
            "b": F.col("b_t0"), "b2": F.col("b2_t0"), "b_lag_1": F.col("b_t1"), "b_lag_3": F.col("b_t3"),
            "b_change_1": F.col("b_t0") - F.col("b_t1"), "b_change_3": F.col("b_t0") - F.col("b_t3"),
        }
    )
    scored = model.transform(inputs)
    per_step = F.col("prediction") / F.lit(float(horizon))
    raw = F.col("a_t0") + per_step if predicts == "change" else F.col("prediction")
    ramps = {
        c: S.ramp(F.col(c), F.col("total_change"), F.lit(period), F.col("last_period"), F.lit(end_period))
        for c in ("b_latest", "b2_latest")
    }
    level = S.clip(raw, low, high)
    return scored.select(
        R.ENTITY, R.NAME, R.GROUP, R.GROUP_CODE, "last_period", "scenario", "total_change", "b_latest", "b2_latest",
        F.lit(period).alias("forecast_period"), level.alias("forecast_a"), F.lit(period - 1).alias("input_period"),
        F.col("prediction").alias("predicted_change"), per_step.alias("annualised_change"),
        ramps["b_latest"].alias("b_assumption"), ramps["b2_latest"].alias("b2_assumption"),
        level.alias("a_t0"), F.col("a_t0").alias("a_t1"), F.col("a_t1").alias("a_t2"), F.col("a_t2").alias("a_t3"),
        ramps["b_latest"].alias("b_t0"), F.col("b_t0").alias("b_t1"), F.col("b_t1").alias("b_t2"),
        F.col("b_t2").alias("b_t3"), ramps["b2_latest"].alias("b2_t0"),
    )
