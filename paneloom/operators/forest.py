"""Fitted forests as flat arrays, walked for whole Arrow batches, and the recursive forecast over them.

A forest has no column form that an executor would evaluate fast, and MLlib's ``transform`` would need a job
for each period of a recursion. Compiled to arrays it is walked for all rows and trees of a batch at once, so
the recursion of an entity runs within the batch that holds it: one stage, no state between periods.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneloom import roles as R
from paneloom.operators.scenario import NEEDED, SCENARIOS, scenario_grid
from paneloom.store import new_path

#: Rows walked at once: their features and places in a tree stay in a core's cache.
ROWS = 16_384
#: Groups up to which a row's slots are laid out beside its features.
LAID_OUT = 64


@dataclass(frozen=True)
class ForestModel:
    """A fitted MLlib preparation and forest behind a stored table (level, slot) of the groups it knows.

    ``forest`` is MLlib's model or the path of its stored form, which is loaded into the driver only where MLlib's transform is asked for.
    """

    numeric: tuple[str, ...]
    levels: DataFrame
    n_levels: int
    prepared: PipelineModel | None
    forest: RandomForestRegressionModel | str | None
    group: str = R.GROUP

    @cached_property
    def pipeline(self) -> PipelineModel:
        forest = RandomForestRegressionModel.load(self.forest) if isinstance(self.forest, str) else self.forest
        return PipelineModel(stages=[*self.prepared.stages, forest])

    @cached_property
    def trees(self) -> Trees:
        return compile_forest(self)

    def with_slot(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``_group_no``; a group not known has the number after the last."""
        known = self.levels.select(F.col("level").alias("_level"), F.col("slot").alias("_slot"))
        joined = rows.join(known, F.col(self.group) == F.col("_level"), "left")
        return joined.withColumn("_group_no", F.coalesce("_slot", F.lit(self.n_levels)).cast("double")).drop("_level", "_slot")

    def transform(self, rows: DataFrame) -> DataFrame:
        """MLlib's own transform."""
        scored = self.pipeline.transform(self.with_slot(rows))
        return scored.select(*rows.columns, "prediction")

    def walked(self, slotted: DataFrame, name: str) -> DataFrame:
        """``slotted`` rows (of ``with_slot``) and the same value as a column, by the compiled nodes. A null feature is an error, as for MLlib."""
        trees = self.trees

        def walk(*columns: pa.Array) -> pa.Array:
            *x, slot = (c.to_numpy(zero_copy_only=False).astype(float) for c in columns)
            x = np.stack(x, axis=1)
            if np.isnan(x).any():
                raise ValueError("a feature of a row to predict is null or NaN")
            parts = [trees.predict(x[i : i + ROWS], slot[i : i + ROWS]) for i in range(0, len(x), ROWS)]
            return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

        return slotted.withColumn(name, F.arrow_udf(walk, "double")(*[F.col(c).cast("double") for c in self.numeric], F.col("_group_no")))


@dataclass(frozen=True)
class Trees:
    """All nodes of a forest, tree by tree. A right child follows its left one; a leaf leads to itself; ``feature`` p + g is the slot of group g."""

    mean: np.ndarray
    scale: np.ndarray
    factor: np.ndarray
    slots: int
    begin: np.ndarray
    depth: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray, slot: np.ndarray) -> np.ndarray:
        """The mean of the trees' values for rows of numeric features and group numbers."""
        z = (x - self.mean) * self.scale * self.factor  # the scaler's arithmetic, in its order
        n, p = z.shape
        laid_out = self.slots <= LAID_OUT
        if laid_out:
            z = np.concatenate([z, slot[:, None] == np.arange(self.slots)], axis=1)
        width = z.shape[1]
        z, offset = z.reshape(-1), np.arange(n) * width
        total = np.zeros(n)
        for i, depth in enumerate(self.depth):
            own = slice(self.begin[i], self.begin[i + 1])
            feature, left, threshold = self.feature[own].astype(np.intp), self.left[own].astype(np.intp), self.threshold[own]
            node = np.zeros(n, np.intp)
            for _ in range(depth):
                at = feature.take(node)
                value = z.take(at + offset) if laid_out else np.where(at < p, z.take(np.minimum(at, p - 1) + offset), slot == at - p)
                over = value > threshold.take(node)
                node = left.take(node)
                node += over
            total += self.value[own].take(node)
        return total / len(self.depth)


def z_scaling(pipeline: PipelineModel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, inverse deviation and factor of the z-scores of ``models.preprocessing``."""
    scaler, factor = pipeline.stages[1], pipeline.stages[2]
    sd = np.array(scaler.std.toArray())
    return np.array(scaler.mean.toArray()), np.divide(1.0, sd, out=np.zeros_like(sd), where=sd != 0), np.array(factor.getScalingVec().toArray())


def compile_forest(model: ForestModel) -> Trees:
    """Read the nodes of a fitted forest from its stored form; at most trees * 2**(depth + 1) rows of eight numbers.

    They travel to the executors with the function that walks them.
    """
    spark, path = model.levels.sparkSession, model.forest
    if not isinstance(path, str):
        path = new_path(spark, "forest")
        model.forest.write().save(path)
    node = F.col("nodeData")
    split = node.getField("split")
    stored = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("id"), node["prediction"].alias("value"), node["leftChild"].alias("left"), node["rightChild"].alias("right"),
        split["featureIndex"].alias("feature"), F.try_element_at(split["leftCategoriesOrThreshold"], F.lit(1)).alias("threshold"), split["numCategories"].alias("kinds"),
    )
    found = {c: col.to_numpy() for c, col in zip(stored.columns, stored.toArrow().columns, strict=True)}
    order = np.lexsort((found["id"], found["tree"]))
    found = {c: v[order] for c, v in found.items()}
    roots = np.flatnonzero(found["id"] == 0)
    begin = np.append(roots, len(order))
    offset = begin[np.searchsorted(begin, np.arange(len(order)), "right") - 1]  # ids count from 0 in each tree
    leaf = found["left"] < 0
    left, right = offset + found["left"], offset + found["right"]
    # A slot is 0 or 1; the split names the values that go left.
    slot, threshold = found["kinds"] > 0, found["threshold"].astype(float)
    ones_left = slot & (threshold == 1.0)
    left, right = np.where(ones_left, right, left), np.where(ones_left, left, right)
    # Anew in each tree: level by level, a right child behind its left one.
    levels, depth, now = [], np.zeros(len(roots), int), roots
    while len(now):
        levels.append(now)
        inner = now[~leaf[now]]
        depth[np.searchsorted(begin, inner, "right") - 1] = len(levels)
        now = np.stack([left[inner], right[inner]], axis=1).reshape(-1)
    order = np.concatenate(levels)
    order = order[np.argsort(offset[order], kind="stable")]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    leaf, slot, threshold, offset = leaf[order], slot[order], threshold[order], offset[order]
    mean, scale, factor = z_scaling(model.prepared)
    return Trees(
        mean=mean, scale=scale, factor=factor, slots=model.n_levels, begin=begin, depth=depth, feature=np.where(leaf, 0, found["feature"][order]).astype(np.int32),
        threshold=np.where(leaf, np.inf, np.where(slot, 0.5, threshold)), left=(np.where(leaf, place[order], place[np.where(leaf, 0, left[order])]) - offset).astype(np.int32),
        value=found["value"][order].astype(float),
    )


_STATE = [f"{m}_t{k}" for m in ("a", "b") for k in range(4)] + ["b2_t0", "total_change"]
_STEP = [
    ("forecast_period", T.IntegerType()), ("forecast_a", T.DoubleType()), ("input_period", T.IntegerType()), ("predicted_change", T.DoubleType()),
    ("annualised_change", T.DoubleType()), ("b_assumption", T.DoubleType()), ("b2_assumption", T.DoubleType()),
]


def roll_trees(
    trees: Trees, numeric: tuple[str, ...], state: Mapping[str, np.ndarray], last: np.ndarray, slot: np.ndarray,
    end_period: int, predicts: str, horizon: int, low: float, high: float,
) -> tuple[np.ndarray, list[np.ndarray]]:
    """The recursion of ``scenario.roll_forward`` for a block of rows: (row numbers, the columns of their steps)."""
    past = {k: v.copy() for k, v in state.items()}
    rows, columns = [], []
    alive = np.arange(len(last))
    for step in range(1, int(end_period - last.min()) + 1 if len(last) else 0):
        known = last[alive] + step <= end_period
        for needed in NEEDED[predicts]:
            known &= ~np.isnan(past[needed][alive])
        alive = alive[known]
        if not len(alive):
            break
        now = {k: v[alive] for k, v in past.items()}
        features = {
            R.PERIOD: (last[alive] + step - 1).astype(float),
            "a": now["a_t0"], "a_lag_1": now["a_t1"], "a_lag_2": now["a_t2"], "a_lag_3": now["a_t3"],
            "a_change_1": now["a_t0"] - now["a_t1"], "a_change_3": now["a_t0"] - now["a_t3"],
            "b": now["b_t0"], "b2": now["b2_t0"], "b_lag_1": now["b_t1"], "b_lag_3": now["b_t3"],
            "b_change_1": now["b_t0"] - now["b_t1"], "b_change_3": now["b_t0"] - now["b_t3"],
        }
        prediction = trees.predict(np.stack([features[c] for c in numeric], axis=1), slot[alive])
        per_step = prediction / horizon
        level = np.clip(now["a_t0"] + per_step if predicts == "change" else prediction, low, high)
        growth = 1.0 + now["total_change"] * (step / (end_period - last[alive]))
        b_now, b2_now = state["b_t0"][alive] * growth, state["b2_t0"][alive] * growth
        rows.append(alive)
        period = last[alive] + step
        columns.append([period, level, period - 1, prediction, per_step, b_now, b2_now])
        for metric, latest in (("a", level), ("b", b_now)):
            for k in (3, 2, 1):
                past[f"{metric}_t{k}"][alive] = now[f"{metric}_t{k - 1}"]
            past[f"{metric}_t0"][alive] = latest
        past["b2_t0"][alive] = b2_now
    if not rows:
        return np.zeros(0, np.int64), [np.zeros(0)] * len(_STEP)
    return np.concatenate(rows), [np.concatenate(c) for c in zip(*columns, strict=True)]


def forecast_with_forest(
    model: ForestModel,
    state: DataFrame,
    end_period: int,
    predicts: str,
    scenarios: Mapping[str, float] = SCENARIOS,
    horizon: int = 3,
    low: float = 0.0,
    high: float = 100.0,
) -> DataFrame:
    """The recursive forecast of ``scenario.roll_forward`` with a forest as its predictor, all periods in one pass."""
    trees = model.trees
    live = state.where(F.col("last_period") < end_period).dropna(subset=list(NEEDED[predicts]))
    grid = scenario_grid(model.with_slot(live), scenarios)
    columns = [R.ENTITY, R.NAME, R.GROUP, R.GROUP_CODE, "scenario", "total_change"]
    source = grid.select(
        F.struct(*columns).alias("row"), F.col("last_period").cast("bigint").alias("last_period"), F.col("_group_no").cast("bigint").alias("slot"),
        *[F.col(c).cast("double").alias(c) for c in _STATE],
    )
    schema = T.StructType([source.schema["row"], *[T.StructField(n, t) for n, t in _STEP]])
    numeric = tuple(model.numeric)

    def roll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                part = batch.slice(begin, ROWS)
                plain = {c: part.column(i).to_numpy(zero_copy_only=False) for i, c in enumerate(part.schema.names) if c != "row"}
                values = {c: plain[c].astype(float) for c in _STATE}
                rows, found = roll_trees(trees, numeric, values, plain["last_period"], plain["slot"], end_period, predicts, horizon, low, high)
                kinds = [pa.int32() if isinstance(t, T.IntegerType) else pa.float64() for _, t in _STEP]
                out = [pa.array(c.astype(k.to_pandas_dtype()), k) for c, k in zip(found, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows)), *out], names=["row", *[n for n, _ in _STEP]])

    rolled = source.mapInArrow(roll, schema).select("row.*", *[n for n, _ in _STEP])
    return rolled if predicts == "change" else rolled.drop("predicted_change", "annualised_change")
