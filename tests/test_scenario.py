"""The recursive forecast against a plain brute-force recursion, and rule by rule."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from paneloom import roles as R
from paneloom.operators import scenario as SC
from paneloom.operators.quality import ContractError

COLUMNS = "entity int, name string, period int, a double, b double, b2 double, grp string, grp_code int"
CHANGE = SC.LinearForm(
    0.5, {"period": 0.001, "a": -0.05, "a_change_1": 0.2, "a_change_3": 0.3, "b": 0.04, "b2": 0.001,
          "b_lag_1": -0.02, "b_lag_3": 0.01, "b_change_1": 0.3, "b_change_3": -0.2}, {"G1": 1.0, "G2": -2.0},
)
LEVEL = SC.LinearForm(1.0, {"a": 0.7, "a_lag_1": 0.1, "a_lag_2": 0.1, "a_lag_3": 0.05, "b": 0.1, "b_change_3": 0.2}, {"G1": 2.0})
SCENARIOS = {"down": -0.1, SC.CONSTANT: 0.0, "up": 0.1}


def row(entity, period, a=50.0, b=10.0, b2=100.0, grp="G1"):
    return (entity, f"n{entity}", period, a, b, b2, grp, 1)


def history(entity, periods, **values):
    return [row(entity, p, **values) for p in periods]


def roll(spark, rows, form=CHANGE, predicts="change", end=2008, scenarios=SCENARIOS):
    state = SC.latest_state(SC.forecast_history(spark.createDataFrame(rows, COLUMNS)))
    return SC.roll_forward(state, end, form, predicts, scenarios)


def steps(df):
    return sorted({(r.entity, r.forecast_period) for r in df.collect()})


def brute(rows, form, predicts, end, scenarios, low=0.0, high=100.0):
    """Plain dictionaries, one entity, scenario and period at a time."""
    out = {}
    for e in {r[0] for r in rows}:
        known = {r[2]: r for r in rows if r[0] == e and None not in r[:7]}
        if not known:
            continue
        last = max(known)
        for name, total in scenarios.items():
            a = {p: r[3] for p, r in known.items()}
            b = {p: r[4] for p, r in known.items()}
            c = {p: r[5] for p, r in known.items()}
            for p in range(last + 1, end + 1):
                t = p - 1
                need = [t, t - 1, t - 3] if predicts == "change" else [t, t - 1, t - 2, t - 3]
                if any(q not in a for q in need):
                    break
                f = {
                    "period": t, "a": a[t], "a_lag_1": a[t - 1], "a_lag_2": a.get(t - 2), "a_lag_3": a[t - 3],
                    "a_change_1": a[t] - a[t - 1], "a_change_3": a[t] - a[t - 3], "b": b[t], "b2": c[t],
                    "b_lag_1": b[t - 1], "b_lag_3": b[t - 3], "b_change_1": b[t] - b[t - 1], "b_change_3": b[t] - b[t - 3],
                }
                pred = form.intercept + sum(w * f[n] for n, w in form.weights.items())
                pred += form.group_effects.get(known[last][6], 0.0)
                level = a[t] + pred / 3 if predicts == "change" else pred
                a[p] = max(low, min(high, level))
                growth = 1 + total * max(0.0, min(1.0, (p - last) / (end - last)))
                b[p], c[p] = known[last][4] * growth, known[last][5] * growth
                out[(e, name, p)] = (a[p], b[p], c[p], pred)
    return out


@pytest.mark.parametrize("form, predicts", [(CHANGE, "change"), (LEVEL, "level")])
@pytest.mark.parametrize("seed", [1, 2])
def test_fold_equals_brute_force(spark, form, predicts, seed):
    rng = random.Random(seed)
    rows = []
    for e in range(60):
        for p in range(1995, rng.choice([1999, 2001, 2002, 2009])):
            if rng.random() < 0.85:
                metrics = [None if rng.random() < 0.04 else rng.uniform(0, 100) for _ in range(3)]
                rows.append((e, f"n{e}", p, *metrics, f"G{e % 4}", e % 4))
    want = brute(rows, form, predicts, 2008, SCENARIOS)
    got = {(r.entity, r.scenario, r.forecast_period): r for r in roll(spark, rows, form, predicts).collect()}
    assert set(got) == set(want) and len(want) > 100
    for key, (a, b, c, pred) in want.items():
        r = got[key]
        values = [r.forecast_a, r.b_assumption, r.b2_assumption]
        assert values == pytest.approx([a, b, c], rel=1e-9, abs=1e-9)
        if predicts == "change":
            assert [r.predicted_change, r.annualised_change] == pytest.approx([pred, pred / 3], rel=1e-9, abs=1e-9)


def test_each_entity_starts_at_its_own_last_period(spark):
    rows = history(1, range(2000, 2004)) + history(2, range(2000, 2006))
    got = steps(roll(spark, rows))
    assert min(p for e, p in got if e == 1) == 2004 and min(p for e, p in got if e == 2) == 2006


def test_nothing_for_entities_at_or_past_the_end(spark):
    rows = history(1, range(2000, 2009)) + history(2, range(2000, 2011))
    assert steps(roll(spark, rows)) == []


def test_incomplete_rows_go_first(spark):
    rows = history(1, range(2000, 2005)) + [row(1, 2005, b2=None)]
    assert min(p for _, p in steps(roll(spark, rows))) == 2005


def test_gap_two_back_lets_the_change_model_make_one_step(spark):
    rows = history(1, [2000, 2001, 2003, 2004])
    assert steps(roll(spark, rows)) == [(1, 2005)]
    assert steps(roll(spark, rows, LEVEL, "level")) == []


@pytest.mark.parametrize("missing", [2001, 2003])
def test_gap_in_a_needed_period_stops_at_once(spark, missing):
    rows = history(1, [p for p in range(2000, 2005) if p != missing])
    assert steps(roll(spark, rows)) == []


def test_all_scenarios_agree_on_the_first_step(spark):
    rows = roll(spark, history(1, range(2000, 2005))).collect()
    first = {r.forecast_a for r in rows if r.forecast_period == 2005}
    later = {r.forecast_a for r in rows if r.forecast_period == 2008}
    assert len(first) == 1 and len(later) == 3


def test_supply_ramps_to_the_full_change(spark):
    rows = roll(spark, history(1, range(2001, 2005))).where("scenario = 'up'").orderBy("forecast_period").collect()
    assert [r.b_assumption for r in rows] == pytest.approx([10.25, 10.5, 10.75, 11.0])
    assert [r.b2_assumption for r in rows] == pytest.approx([102.5, 105.0, 107.5, 110.0])


def test_level_is_clipped_and_the_change_is_not(spark):
    form = SC.LinearForm(400.0, {})
    rows = roll(spark, history(1, range(2001, 2005)), form).collect()
    assert {r.forecast_a for r in rows} == {100.0} and {r.predicted_change for r in rows} == {400.0}
    assert {r.forecast_a for r in roll(spark, history(1, range(2001, 2005)), SC.LinearForm(-9.0, {}), "level").collect()} == {0.0}


def test_emit_window_and_empty_forecast(spark):
    rolled = roll(spark, history(1, range(2000, 2004)))
    assert min(p for _, p in steps(SC.emit_window(rolled, 2006))) == 2006
    with pytest.raises(ContractError, match="no forecasts"):
        SC.require_forecast(SC.emit_window(rolled, 2050))


def test_impact_and_spread(spark):
    rolled = roll(spark, history(1, range(2000, 2004)))
    impact = {r.scenario: r.impact for r in SC.impact_vs_constant(rolled, 2008).collect()}
    assert impact[SC.CONSTANT] == 0.0
    assert SC.scenario_spread(rolled, 2008).first().spread == pytest.approx(max(impact.values()) - min(impact.values()))


def test_matched_scenarios():
    assert SC.matched_scenarios(5) == ["Sugar -5% by 2030", "Constant sugar", "Sugar +5% by 2030"]


def test_merged_change_weights_keep_the_value(spark):
    features = {n: F.lit(float(i + 1)) for i, n in enumerate(["a", "a_lag_1", "a_lag_3", "b", "b_lag_1"])}
    features |= {"a_change_1": features["a"] - features["a_lag_1"], R.GROUP: F.lit("G1")}
    form = SC.LinearForm(1.0, {"a": 2.0, "a_change_1": 3.0, "b_lag_1": 0.5}, {"G1": 10.0})
    assert spark.range(1).select(form(features)).first()[0] == pytest.approx(1 + 2 * 1 + 3 * (1 - 2) + 0.5 * 5 + 10)
