from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paneloom import roles as R
from paneloom.operators import evaluation as EV
from paneloom.operators import features as FE
from paneloom.operators import models as M
from paneloom.operators import scenario as SC
from paneloom.operators.quality import ContractError
from paneloom.plans import training as TR
from paneloom.sources import tables as TB
from paneloom.store import materialise, new_path

COLUMNS = "entity int, name string, period int, a double, b double, b2 double, grp string, grp_code int"


@pytest.fixture(scope="module")
def panel(spark):
    rng = random.Random(7)
    rows = []
    for e in range(40):
        a, b = rng.uniform(20, 60), rng.uniform(10, 40)
        for p in range(2000, 2020):
            a += 0.05 * (b - 25) / 10 + rng.gauss(0, 0.4)
            b += rng.gauss(0, 1)
            rows.append((e, f"n{e}", p, a, b, 10 * b + rng.gauss(0, 3), f"G{e % 3}", e % 3))
    return materialise(spark.createDataFrame(rows, COLUMNS), "panel")


@pytest.fixture(scope="module")
def split(panel):
    rows = FE.training_rows(FE.change_features(panel), FE.CHANGE_NUMERIC, FE.CHANGE_TARGET)
    return FE.time_split(materialise(rows, "rows"), 2012)


def design(rows):
    """Standardised numerics and 0/1 groups as numpy, fitted on the first frame."""
    frames = [r.toPandas().sort_values(["entity", "period"]) for r in rows]
    mean, sd = frames[0][FE.CHANGE_NUMERIC].mean(), frames[0][FE.CHANGE_NUMERIC].std(ddof=0)
    out = []
    for f in frames:
        z = ((f[FE.CHANGE_NUMERIC] - mean) / sd).to_numpy()
        d = np.stack([(f["grp"] == g).to_numpy(float) for g in ("G0", "G1", "G2")], axis=1)
        out.append((np.hstack([z, d]), f[FE.CHANGE_TARGET].to_numpy()))
    return out


def predictions(model, test):
    return M.predict(model, test).toPandas().sort_values(["entity", "period"])["prediction"].to_numpy()


def test_ridge_equals_the_closed_form(split):
    train, test = split
    (x, y), (xt, _) = design([train, test])
    centre = x.mean(axis=0)
    w = np.linalg.solve((x - centre).T @ (x - centre) + np.eye(x.shape[1]), (x - centre).T @ (y - y.mean()))
    got = predictions(M.fit(M.ridge(FE.CHANGE_TARGET), train, FE.CHANGE_NUMERIC), test)
    assert got == pytest.approx((xt - centre) @ w + y.mean(), abs=1e-9)


def test_ols_equals_least_squares_on_collinear_features(split):
    train, test = split
    (x, y), (xt, _) = design([train, test])
    centre = x.mean(axis=0)
    w = np.linalg.lstsq(x - centre, y - y.mean(), rcond=1e-10)[0]
    got = predictions(M.fit(M.ols(FE.CHANGE_TARGET), train, FE.CHANGE_NUMERIC), test)
    assert got == pytest.approx((xt - centre) @ w + y.mean(), abs=1e-8)


def test_unknown_group_is_all_zeros(spark, split):
    train, test = split
    model = M.fit(M.ridge(FE.CHANGE_TARGET), train, FE.CHANGE_NUMERIC)
    form = M.linear_form(model, FE.CHANGE_NUMERIC)
    stranger = test.limit(5).withColumn(R.GROUP, F.lit("elsewhere"))
    scored = M.predict(model, stranger).withColumn("by_form", form({c: F.col(c) for c in stranger.columns}))
    for r in scored.collect():
        assert r.prediction == pytest.approx(r.by_form, abs=1e-9)


def test_linear_form_equals_the_pipeline(split):
    train, test = split
    model = M.fit(M.ols(FE.CHANGE_TARGET), train, FE.CHANGE_NUMERIC)
    form = M.linear_form(model, FE.CHANGE_NUMERIC)
    scored = M.predict(model, test).withColumn("by_form", form({c: F.col(c) for c in test.columns}))
    assert scored.agg(F.max(F.abs(F.col("prediction") - F.col("by_form")))).first()[0] < 1e-8


@pytest.mark.parametrize("predicts", ["change", "level"])
def test_stepwise_forecast_equals_the_fold(spark, panel, predicts):
    """Entities with different last periods and gaps, through both forms of the recursion."""
    gapped = panel.where("not (entity % 5 = 1 and period = 2017) and not (entity % 7 = 2 and period > 2016)")
    features = FE.change_features(panel) if predicts == "change" else FE.next_period_features(panel)
    numeric, target = (
        (FE.CHANGE_NUMERIC, FE.CHANGE_TARGET) if predicts == "change" else (FE.LEVEL_NUMERIC, FE.LEVEL_TARGET)
    )
    train = FE.training_rows(features, numeric, target).where("period <= 2012")
    model = M.fit(M.ols(target), train, numeric)
    state = materialise(SC.latest_state(SC.forecast_history(gapped)), "state")
    scenarios = {"down": -0.1, SC.CONSTANT: 0.0}
    fold = SC.roll_forward(state, 2024, M.linear_form(model, numeric), predicts, scenarios)
    steps = M.forecast_with_model(model, state, 2024, predicts, scenarios)
    key = ["entity", "scenario", "forecast_period"]
    both = fold.select(*key, "forecast_a", "b_assumption").join(
        steps.select(*key, F.col("forecast_a").alias("x"), F.col("b_assumption").alias("y")), key, "full"
    )
    worst = both.agg(
        F.max(F.abs(F.col("forecast_a") - F.col("x"))), F.max(F.abs(F.col("b_assumption") - F.col("y"))),
        F.count("*"), F.count("forecast_a"), F.count("x"),
    ).first()
    assert worst[0] < 1e-7 and worst[1] < 1e-9 and worst[2] == worst[3] == worst[4] > 100


def test_training_flags_the_better_linear_model(panel):
    trained = TR.train_change_model(FE.change_features(panel), 2012, trees=5, depth=3)
    metrics = {r.model: r for r in trained.metrics.collect()}
    assert set(metrics) == {"naive_previous_3yr_change", "linear_regression", "ridge_regression", "random_forest"}
    best = min(TR.LINEAR, key=lambda m: (metrics[m].mae, m))
    assert [m for m, r in metrics.items() if r.selected_for_scenarios] == [best] == [trained.selected]
    assert trained.predictions.select("model").distinct().count() == 3
    forecast = TR.forecast(panel, trained.models[trained.selected], trained.selected, "change", 2020, 2026)
    assert forecast.count() == 40 * 7 * 7
    assert {r.model_name for r in forecast.select("model_name").distinct().collect()} == {trained.selected}


def test_level_training_selects_among_fitted_models_only(panel):
    trained = TR.train_level_model(FE.next_period_features(panel), 2012, trees=5, depth=3)
    assert [r.mae for r in trained.metrics.collect()] == sorted(r.mae for r in trained.metrics.collect())
    assert trained.selected in ("linear_regression", "random_forest")


def test_metrics_equal_their_definitions(spark):
    y, p = np.array([1.0, 2.0, 4.0, 8.0]), np.array([1.5, 2.0, 3.0, 9.0])
    row = EV.regression_metrics(spark.createDataFrame(list(zip(y.tolist(), p.tolist())), "y double, p double"), "y", "p").first()
    e = p - y
    want = [abs(e).mean(), (e**2).mean() ** 0.5, 1 - (e**2).sum() / ((y - y.mean()) ** 2).sum()]
    assert [row.mae, row.rmse, row.r2] == pytest.approx(want)


def test_published_metrics_select_the_published_model(spark):
    rows = [
        ("naive_previous_3yr_change", 0.105147, False),
        ("linear_regression", 0.052136, False),
        ("ridge_regression", 0.058194, False),
        ("random_forest", 0.060631, False),
    ]
    df = spark.createDataFrame(rows, "model string, mae double, selected_for_scenarios boolean")
    flagged = EV.flag_selected(df, F.col("model").isin(TR.LINEAR))
    assert [r.model for r in flagged.where("selected_for_scenarios").collect()] == ["linear_regression"]
    assert EV.model_card(df).first().model == "linear_regression"
    text = df.withColumn("selected_for_scenarios", F.when(F.col("model") == "random_forest", F.lit("True")).otherwise(F.lit("")))
    assert EV.model_card(text).first().model == "random_forest"


def test_mean_stands_in_for_a_missing_change(spark):
    test = spark.createDataFrame([(None,), (2.0,)], "a_change_3 double")
    train = spark.createDataFrame([(1.0,), (5.0,)], "t double")
    assert [r.prediction for r in EV.previous_change_baseline(test, train, "a_change_3", "t").collect()] == [3.0, 2.0]


def test_constant_column_is_only_centred(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, c double")
    assert [tuple(r) for r in FE.z_scores(df, ["x", "c"], df).select("z_x", "z_c").collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_empty_side_of_a_split_is_an_error(panel):
    with pytest.raises(ContractError, match="empty side"):
        FE.time_split(panel, 1900)


def test_row_features_drop_incomplete_rows_before_lagging(spark):
    rows = [(1, "n", p, float(p), None if p == 3 else 1.0, 1.0, "G", 1) for p in range(1, 8)]
    df = spark.createDataFrame(rows, COLUMNS)
    change = {r.period: r.a_lag_1 for r in FE.change_features(df).collect()}
    level = {r.period: r.a_lag_1 for r in FE.next_period_features(df).collect()}
    assert 3 not in change and change[4] == 2.0 and level[4] == 3.0


def test_bundle_round_trip_and_errors(spark, split):
    train, test = split
    model = M.fit(M.ols(FE.CHANGE_TARGET), train, FE.CHANGE_NUMERIC)
    path = new_path(spark, "bundle")
    TB.save_bundle(model, path, None, FE.CHANGE_NUMERIC, FE.CHANGE_TARGET, 3, "test")
    loaded, about = TB.load_bundle(spark, path, "fallback_name")
    assert about["selected_model_name"] == "fallback_name" and about["horizon"] == 3
    assert predictions(loaded, test) == pytest.approx(predictions(model, test))
    with pytest.raises(FileNotFoundError):
        TB.load_bundle(spark, path + "-absent")
    spark.read.parquet(f"{path}/about").write.parquet(f"{path}-half/about")
    with pytest.raises(ContractError):
        TB.load_bundle(spark, f"{path}-half")


def test_a_bundle_changes_as_a_whole(spark, split):
    """A save whose second write fails leaves the bundle before; then a forest takes its place, and old generations go."""
    train, test = split
    path = new_path(spark, "bundle")
    linear = M.fit(M.ols(FE.CHANGE_TARGET), train, FE.CHANGE_NUMERIC)
    forest = M.fit(M.forest(FE.CHANGE_TARGET, trees=3, depth=3), train, FE.CHANGE_NUMERIC)
    save = lambda model, name, horizon: TB.save_bundle(model, path, name, FE.CHANGE_NUMERIC, FE.CHANGE_TARGET, horizon, "test")
    save(linear, "linear", 3)
    with pytest.raises(Exception, match="horizon"):
        save(forest, "broken", "no number")
    loaded, about = TB.load_bundle(spark, path)
    assert about["selected_model_name"] == "linear" and predictions(loaded, test) == pytest.approx(predictions(linear, test), abs=1e-12)
    save(forest, "forest", 3)
    loaded, about = TB.load_bundle(spark, path)
    assert about["selected_model_name"] == "forest" and predictions(loaded, test) == pytest.approx(predictions(forest, test), abs=1e-12)
    save(linear, "linear again", 3)
    assert TB.sweep_bundle(spark, path, keep=1) == 2
    assert TB.load_bundle(spark, path)[1]["selected_model_name"] == "linear again"


def test_forest_is_a_property_of_the_rows(split):
    """Equal trees from one partition, from many, and from rows in another order."""
    train, test = split
    estimator = M.forest(FE.CHANGE_TARGET, trees=10, depth=5)
    one, many, turned = (
        predictions(M.fit(estimator, rows, FE.CHANGE_NUMERIC), test)
        for rows in (train.coalesce(1), train.repartition(13), train.orderBy(F.desc("period"), "entity"))
    )
    assert (one == many).all() and (one == turned).all()
    assert len(set(one.round(9))) > 10


def test_buffer_of_a_forest_does_not_change_it(split):
    train, test = split
    small, large = (
        predictions(M.fit(M.forest(FE.CHANGE_TARGET, trees=10, depth=5, buffer_mb=mb), train, FE.CHANGE_NUMERIC), test)
        for mb in (1, 64)
    )
    assert (small == large).all()


def test_more_groups_than_allowed_are_an_error(split):
    train, _ = split
    with pytest.raises(ContractError, match="more than 2 levels"):
        M.fit_all({"ols": M.ols(FE.CHANGE_TARGET)}, train, FE.CHANGE_NUMERIC, max_levels=2)


def test_forecast_of_nothing_is_an_error(panel):
    trained = TR.train_change_model(FE.change_features(panel), 2012, trees=2, depth=2)
    with pytest.raises(ContractError, match="no forecasts"):
        TR.forecast(panel, trained.models[trained.selected], trained.selected, "change", 2040, 2026)
