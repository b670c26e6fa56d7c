"""Trees against an exact split search, the walk over compiled nodes, and forecasts, scoring and fits at many groups."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from paneloom import roles as R
from paneloom.operators import features as FE
from paneloom.operators import models as M
from paneloom.operators import scenario as SC
from paneloom.operators.forest import compile_forest, forecast_with_forest
from paneloom.operators.quality import ContractError
from paneloom.plans import training as TR
from paneloom.store import materialise

COLUMNS = "entity int, name string, period int, a double, b double, b2 double, grp string, grp_code int"


def make_panel(spark, entities, groups, periods=range(2000, 2020), gaps=False):
    rng = random.Random(11)
    rows = []
    for e in range(entities):
        a, b = rng.uniform(20, 60), rng.uniform(10, 40)
        for p in periods:
            a += 0.05 * (b - 25) / 10 + rng.gauss(0, 0.4) + 0.2 * (e % groups % 3)
            b += rng.gauss(0, 1)
            if not (gaps and (e % 5 == 1 and p == 2017 or e % 7 == 2 and p > 2016)):
                rows.append((e, f"n{e}", p, a, b, 10 * b + rng.gauss(0, 3), f"G{e % groups}", e % groups))
    return materialise(spark.createDataFrame(rows, COLUMNS), "panel")


@pytest.fixture(scope="module")
def panel(spark):
    return make_panel(spark, 40, 3, gaps=True)


def rows_for(panel, predicts):
    features = FE.change_features(panel) if predicts == "change" else FE.next_period_features(panel)
    numeric, target = (FE.CHANGE_NUMERIC, FE.CHANGE_TARGET) if predicts == "change" else (FE.LEVEL_NUMERIC, FE.LEVEL_TARGET)
    return materialise(FE.training_rows(features, numeric, target), "rows"), numeric, target


def grow(x, y, depth):
    """An exact regression tree: every midpoint of every feature, by squared error."""
    if depth == 0 or len(set(y)) == 1:
        return y.mean()
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for t in (values[1:] + values[:-1]) / 2:
            left = x[:, f] <= t
            error = ((y[left] - y[left].mean()) ** 2).sum() + ((y[~left] - y[~left].mean()) ** 2).sum()
            if best is None or error < best[0] - 1e-9:
                best = (error, f, t)
    if best is None:
        return y.mean()
    _, f, t = best
    left = x[:, f] <= t
    return f, t, grow(x[left], y[left], depth - 1), grow(x[~left], y[~left], depth - 1)


def walk(tree, row):
    while isinstance(tree, tuple):
        f, t, left, right = tree
        tree = left if row[f] <= t else right
    return tree


def test_an_unbagged_tree_is_the_exact_one(panel):
    rows, numeric, target = rows_for(panel, "change")
    train, _ = FE.time_split(rows, 2010)
    estimator = M.forest(target, trees=1, depth=3).setBootstrap(False).setMaxBins(1000)
    model = M.fit(estimator, train, numeric)
    frame = M.predict(model, train).toPandas()
    x = np.hstack([frame[numeric].to_numpy(float), np.stack([(frame["grp"] == g).to_numpy(float) for g in ("G0", "G1", "G2")], 1)])
    tree = grow(x, frame[target].to_numpy(), 3)
    got = frame["prediction"].to_numpy()
    # Splits of different features that part the training rows alike are equally good: the training rows decide.
    assert got == pytest.approx([walk(tree, r) for r in x], abs=1e-9)
    assert len(set(got.round(9))) > 4


def test_a_forest_that_returned_the_mean_would_be_seen(panel):
    rows, numeric, target = rows_for(panel, "change")
    train, test = FE.time_split(rows, 2010)
    model = M.fit(M.forest(target, trees=30, depth=6), train, numeric)
    errors = lambda prediction, frame: frame.agg(F.avg(F.abs(prediction - F.col(target)))).first()[0]
    centre = F.lit(train.agg(F.avg(target)).first()[0])
    assert errors(F.col("prediction"), M.predict(model, test)) < errors(centre, test)
    assert errors(F.col("prediction"), M.predict(model, train)) < 2 / 3 * errors(centre, train)


@pytest.mark.parametrize("trees, depth", [(1, 1), (20, 8)])
def test_compiled_nodes_give_the_transform(panel, trees, depth):
    rows, numeric, target = rows_for(panel, "change")
    model = M.fit(M.forest(target, trees=trees, depth=depth), rows, numeric)
    rows = rows.withColumn(R.GROUP, F.when(F.col("entity") == 7, F.lit("elsewhere")).otherwise(F.col(R.GROUP)))
    frame = model.with_slot(model.transform(rows)).toPandas()
    got = compile_forest(model).predict(frame[numeric].to_numpy(float), frame["_group_no"].to_numpy())
    assert got == pytest.approx(frame["prediction"].to_numpy(), abs=1e-12)


@pytest.mark.parametrize("predicts", ["change", "level"])
def test_forecast_in_one_pass_equals_the_steps(panel, predicts):
    """Entities with different last periods and gaps, an unknown group, clipped levels; no job per period."""
    rows, numeric, target = rows_for(panel, predicts)
    model = M.fit(M.forest(target, trees=12, depth=6), rows.where("period <= 2012"), numeric)
    history = panel.withColumn(R.GROUP, F.when(F.col("entity") == 3, F.lit("elsewhere")).otherwise(F.col(R.GROUP)))
    state = materialise(SC.latest_state(SC.forecast_history(history)), "state")
    scenarios = {"down": -0.1, SC.CONSTANT: 0.0}
    settings = (state, 2024, predicts, scenarios, 3, 30.0, 45.0)
    once, steps = forecast_with_forest(model, *settings), M.forecast_with_model(model, *settings)
    assert once.columns == steps.columns
    key = ["entity", "scenario", "forecast_period"]
    order = lambda df: [r.asDict() for r in df.orderBy(*key).collect()]
    got, want = order(once), order(steps)
    assert len(got) == len(want) > 100 and {r["forecast_period"] for r in got} >= {2017, 2024}
    for a, b in zip(got, want, strict=True):
        for c, value in b.items():
            assert a[c] == (pytest.approx(value, abs=1e-9) if isinstance(value, float) else value)
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "SortMergeJoin" not in plan


def test_forecast_of_no_state(spark, panel):
    rows, numeric, target = rows_for(panel, "level")
    model = M.fit(M.forest(target, trees=2, depth=2), rows, numeric)
    state = SC.latest_state(SC.forecast_history(panel))
    assert forecast_with_forest(model, state, 1990, "level").count() == 0
    assert forecast_with_forest(model, state.where("false"), 2030, "level").count() == 0


def test_scoring_reads_the_test_rows_once(panel):
    rows, numeric, target = rows_for(panel, "change")
    train, test = FE.time_split(rows, 2010)
    models = M.fit_all({"ols": M.ols(target), "ridge": M.ridge(target), "forest": M.forest(target, 5, 4), "second": M.forest(target, 3, 2)}, train, numeric)
    test = materialise(test, "scored-once")
    long = M.predictions_long(models, test, {"last": F.col("a_change_3")})
    plan = long._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("_change_1#") and sum("period#" in line for line in plan.splitlines() if "Relation" in line) == 1
    found = {(r.model, r.entity, r.period): r.prediction for r in long.collect()}
    for name, model in models.items():
        for r in M.predict(model, test).collect():
            assert found.pop((name, r.entity, r.period)) == pytest.approx(r.prediction, abs=1e-12)
    assert {name for name, _, _ in found} == {"last"} and len(found) == test.count()


def test_plan_of_a_forecast_does_not_grow_with_the_groups(spark):
    sizes = []
    for groups in (3, 2000):
        panel = make_panel(spark, 2 * groups, groups, range(2000, 2007))
        rows, numeric, target = rows_for(panel, "change")
        model = M.fit(M.ridge(target), rows, numeric)
        forecast = TR.forecast(panel, model, "ridge", "change", 2007, 2010, {SC.CONSTANT: 0.0})
        sizes.append(len(re.sub(r"\d+", "", forecast._jdf.queryExecution().analyzed().toString())))
        assert forecast.count() == 2 * groups * 4
        if groups > 3:
            state = materialise(SC.latest_state(SC.forecast_history(panel)), "state")
            by_case = SC.roll_forward(state.where("entity < 20"), 2010, M.linear_form(model, numeric), "change", {SC.CONSTANT: 0.0})
            want = {(r.entity, r.forecast_period): r.forecast_a for r in by_case.collect()}
            got = {(r.entity, r.forecast_period): r.forecast_a for r in forecast.where("entity < 20").collect()}
            assert len(got) == 80 and all(got[k] == pytest.approx(v, abs=1e-9) for k, v in want.items())
    assert sizes[0] == sizes[1]


def test_many_groups_are_fitted(spark):
    """50,000 groups with known effects: both linear fits find them; a forest says that they are too many."""
    groups = 50_000
    rows = spark.range(4 * groups).select(
        (F.col("id") % groups).alias("entity"), F.concat(F.lit("g"), F.col("id") % groups).alias("grp"), F.rand(3).alias("x"), F.randn(4).alias("z")
    )
    effect = F.pmod(F.xxhash64("grp"), F.lit(1000)) / 100
    rows = materialise(rows.withColumn("y", 2 * F.col("x") - 3 * F.col("z") + effect + 1), "wide")
    models = M.fit_all({"ols": M.ols("y"), "ridge": M.ridge("y")}, rows, ["x", "z"])
    assert models["ols"].weights == pytest.approx({"x": 2, "z": -3}, abs=1e-9)
    worst = M.predict(models["ols"], rows).agg(F.max(F.abs(F.col("prediction") - F.col("y")))).first()[0]
    assert worst < 1e-8 and models["ridge"].effects.count() == groups
    index = FE.group_index(rows)
    ends = index.agg(F.min("slot"), F.max("slot"), F.count_distinct("slot"), F.min_by("level", "slot"), F.max_by("level", "slot")).first()
    assert tuple(ends) == (0, groups - 1, groups, "g0", "g9999")
    with pytest.raises(ContractError, match="more than 10000 levels"):
        M.fit_all({"forest": M.forest("y", 1, 1)}, rows, ["x", "z"])


def test_incomplete_training_rows_are_an_error(spark):
    rows = spark.createDataFrame([("g", 1.0, 2.0), ("g", None, 1.0), ("h", 2.0, 1.0)], "grp string, x double, y double")
    for broken in (rows, rows.where("false"), rows.where("x is not null").withColumn("y", F.when(F.col("x") > 1, F.col("y")))):
        with pytest.raises(ContractError, match="training rows"):
            M.fit(M.ols("y"), broken, ["x"])
    model = M.fit(M.ols("y"), rows.where("x is not null"), ["x"])
    assert model.weights == {"x": 0.0}  # one row a group: the groups explain it all


def test_ridge_at_many_groups_is_the_penalised_optimum(spark):
    """The gradient of the penalised sum of squares vanishes, by the definition."""
    rng = np.random.default_rng(5)
    n, groups = 900, 200
    g, x = rng.integers(0, groups, n), rng.normal(size=(n, 2)) * [3.0, 0.1] + 5
    y = x @ [0.4, 7.0] + rng.normal(size=groups)[g] + rng.normal(size=n)
    rows = spark.createDataFrame([(f"g{k}", float(a), float(b), float(c)) for k, (a, b), c in zip(g, x, y, strict=True)], "grp string, x double, z double, y double")
    model = M.fit(M.ridge("y", 2.5), materialise(rows, "rows"), ["x", "z"])
    effects = {r.level: r.effect for r in model.effects.collect()}
    e = np.array([effects.get(f"g{k}", 0.0) for k in range(groups)])
    w = np.array([model.weights["x"], model.weights["z"]]) * x.std(0)
    rest = y - model.intercept - x @ [model.weights["x"], model.weights["z"]] - e[g]
    assert rest.sum() == pytest.approx(0, abs=1e-8)
    assert ((x - x.mean(0)) / x.std(0)).T @ rest == pytest.approx(2.5 * w, abs=1e-8)
    assert np.bincount(g, rest, groups) == pytest.approx(2.5 * e, abs=1e-8)
