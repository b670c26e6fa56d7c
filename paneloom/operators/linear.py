"""Least squares with group effects, by sums: any number of groups, no list of them on the driver.

The slots of a one-hot group are orthogonal, so they leave the normal equations in closed form: what
reaches the driver is a matrix as wide as the numeric features, at every number of groups. Group effects
stay a table (level, effect), stored in the shared folder and joined where they are used.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneloom import roles as R
from paneloom.operators.quality import ContractError
from paneloom.operators.scenario import LinearForm, with_group_effect
from paneloom.store import materialise

#: Directions of the features with less than this share of the largest one's variance count as collinear.
COLLINEAR = 1e-10


@dataclass(frozen=True)
class LeastSquares:
    """Squared residuals plus ``penalty`` times the squared weights, those of the group's slots included."""

    target: str
    penalty: float = 0.0


@dataclass(frozen=True)
class LinearModel:
    """A fitted model in the features' own units; ``effects`` is a table (level, effect), read from a stored one."""

    numeric: tuple[str, ...]
    intercept: float
    weights: Mapping[str, float]
    effects: DataFrame
    group: str = R.GROUP

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``prediction``: null where a feature is; an unknown group has no effect."""
        joined = with_group_effect(rows, self.effects, self.group, "_effect")
        return joined.withColumn("prediction", self.without_groups(F.col) + F.col("_effect")).drop("_effect")

    def form(self) -> LinearForm:
        """The model but for its group effects."""
        return LinearForm(self.intercept, self.weights)

    def without_groups(self, feature: Callable[[str], Column]) -> Column:
        total = F.lit(float(self.intercept))
        for name in self.numeric:
            total = total + feature(name) * F.lit(float(self.weights[name]))
        return total


def fit_least_squares(
    estimators: Mapping[str, LeastSquares], train: DataFrame, numeric: Sequence[str], group: str = R.GROUP
) -> dict[str, LinearModel]:
    """Fit candidates on the rows that have a group, on population z-scores and one 0/1 slot per group.

    The intercept is free of penalty. Without a penalty, collinear features take the weights of least
    norm and the effects add up to 0; predictions do not depend on that choice. ``train`` is read once for the moments
    and once a target for the sums; pass a stored table. A null feature or target is an error, and so is no row.
    """
    train = train.where(F.col(group).isNotNull())
    targets = list(dict.fromkeys(e.target for e in estimators.values()))
    whole = reduce(and_, [F.col(c).isNotNull() for c in [*numeric, *targets]])
    moments = train.agg(
        F.count("*").alias("n"), F.count_if(whole).alias("whole"), *[F.avg(c).alias(f"mean_{c}") for c in numeric], *[F.stddev_pop(c).alias(f"sd_{c}") for c in numeric],
        *[F.avg(c).alias(f"of_{c}") for c in targets],
    ).first()
    if not moments["n"] or moments["whole"] < moments["n"]:
        raise ContractError(f"{moments['whole']} of {moments['n']} training rows have all features and targets")
    mean = np.array([moments[f"mean_{c}"] for c in numeric], float)
    sd = np.array([moments[f"sd_{c}"] for c in numeric], float)
    fitted = {}
    for target in targets:
        mean_y = moments[f"of_{target}"]
        sums = _Sums(train, numeric, mean, sd, target, mean_y, group)
        for name, estimator in estimators.items():
            if estimator.target == target:
                w, intercept, effects = sums.solve(estimator.penalty)
                weights = np.divide(w, sd, out=np.zeros_like(w), where=sd > 0)
                fitted[name] = LinearModel(
                    tuple(numeric), float(intercept + mean_y - weights @ mean), dict(zip(numeric, weights.tolist(), strict=True)), effects, group
                )
    return fitted


class _Sums:
    """Sums of products over all rows, and a stored table of sums per group."""

    def __init__(self, train: DataFrame, numeric: Sequence[str], mean: np.ndarray, sd: np.ndarray, target: str, mean_y: float, group: str) -> None:
        self.p = len(numeric)
        z = [(F.col(c) - F.lit(float(m))) / F.lit(float(s)) if s > 0 else F.lit(0.0) for c, m, s in zip(numeric, mean, sd, strict=True)]
        names = [f"x{i}" for i in range(self.p + 1)]  # x0 is the intercept
        rows = train.select(F.col(group).alias("level"), F.lit(1.0).alias("x0"), *[v.alias(n) for v, n in zip(z, names[1:], strict=True)], (F.col(target) - F.lit(float(mean_y))).alias("y"))
        self.columns = [*names, "y"]
        self.groups = materialise(rows.groupBy("level").agg(*[F.sum(c).alias(c) for c in self.columns]), "group-sums")
        self.total = self._products(rows, F.lit(1.0))

    def _products(self, rows: DataFrame, weight: Column) -> np.ndarray:
        """Sums of the products of any two columns, as a symmetric matrix: one matrix a task, added up cell by cell."""
        k = len(self.columns)

        def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((k, k))
            for batch in batches:
                w, *x = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
                x = np.stack(x, axis=1)
                total += (x * w[:, None]).T @ x
            yield pa.RecordBatch.from_arrays([pa.array([total.reshape(-1).tolist()], pa.list_(pa.float64()))], names=["cells"])

        parts = rows.select(weight.cast("double").alias("w"), *[F.col(c).cast("double") for c in self.columns]).mapInArrow(multiply, "cells array<double>")
        out = np.zeros(k * k)
        for row in parts.select(F.posexplode("cells")).groupBy("pos").agg(F.sum("col").alias("total")).collect():
            out[row.pos] = row.total
        return out.reshape(k, k)

    def solve(self, penalty: float) -> tuple[np.ndarray, float, DataFrame]:
        """Weights on the z-scores, intercept, and the effects (level, effect), a projection of the stored sums."""
        p = self.p
        inside = self.total - self._products(self.groups, F.lit(1.0) / (F.col("x0") + F.lit(float(penalty))))
        count = F.col("x0")
        if penalty:
            left = inside[: p + 1, : p + 1] + np.diag([0.0] + [penalty] * p)
            solution = np.linalg.solve(left, inside[: p + 1, p + 1])
            intercept, w = float(solution[0]), solution[1:]
            rest = F.col("y") - count * F.lit(intercept)
        else:
            values, vectors = np.linalg.eigh(inside[1 : p + 1, 1 : p + 1])
            kept = values > COLLINEAR * max(values[-1], 0.0)
            w = vectors[:, kept] @ ((vectors[:, kept].T @ inside[1 : p + 1, p + 1]) / values[kept])
            intercept, rest = None, F.col("y")
        for i in range(p):
            rest = rest - F.col(f"x{i + 1}") * F.lit(float(w[i]))
        effects = self.groups.select("level", (rest / (count + F.lit(float(penalty)))).alias("effect"))
        if intercept is None:
            intercept = float(effects.agg(F.avg("effect")).first()[0])
            effects = effects.withColumn("effect", F.col("effect") - F.lit(intercept))
        return w, intercept, effects
