"""What-if scenarios and the recursive forecast.

The recursion runs inside one row: an entity's last four periods are folded over its forecast
periods with ``aggregate``, one row per (entity, scenario). There is no job, shuffle or
lineage growth per step, and entities are independent, so it scales with the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneloom import roles as R
from paneloom.functions import scalars as S
from paneloom.operators.clean import drop_missing
from paneloom.operators.quality import require_rows

Predictor = Callable[[Mapping[str, Column]], Column]

# Scenario names and total relative change of supply by the end period.
SCENARIOS = {
    "Sugar -10% by 2030": -0.10,
    "Sugar -5% by 2030": -0.05,
    "Sugar -2% by 2030": -0.02,
    "Constant sugar": 0.00,
    "Sugar +2% by 2030": 0.02,
    "Sugar +5% by 2030": 0.05,
    "Sugar +10% by 2030": 0.10,
}
CONSTANT = "Constant sugar"

# What each kind of predictor needs of the periods t, t-1, t-2 and t-3.
NEEDED = {"change": ("a_t0", "a_t1", "a_t3"), "level": ("a_t0", "a_t1", "a_t2", "a_t3")}

HISTORY_COLUMNS = [R.ENTITY, R.NAME, R.PERIOD, R.METRIC_A, R.METRIC_B, R.METRIC_B2, R.GROUP]


#: The feature that holds a row's group effect, where one has been joined.
GROUP_EFFECT = "group_effect"


@dataclass(frozen=True)
class LinearForm:
    """A linear predictor over feature columns and group effects, usable inside the fold.

    The effects come as the feature GROUP_EFFECT if there is one, as in the fold, else as a CASE over the groups.
    """

    intercept: float
    weights: Mapping[str, float]
    group_effects: Mapping[str, float] = field(default_factory=dict)

    def __call__(self, features: Mapping[str, Column]) -> Column:
        total = F.lit(float(self.intercept))
        for name, weight in self._without_changes().items():
            total = total + features[name] * F.lit(float(weight))
        if GROUP_EFFECT in features:
            total = total + features[GROUP_EFFECT]
        elif self.group_effects:
            effect = None
            for group, value in self.group_effects.items():
                effect = (F if effect is None else effect).when(features[R.GROUP] == group, F.lit(float(value)))
            total = total + effect.otherwise(F.lit(0.0))
        return total

    def _without_changes(self) -> dict[str, float]:
        """Weights with every ``m_change_k`` put onto ``m`` and ``m_lag_k``: fewer terms, same value."""
        merged = {n: w for n, w in self.weights.items() if "_change_" not in n}
        for name, weight in self.weights.items():
            if "_change_" in name:
                metric, k = name.split("_change_")
                merged[metric] = merged.get(metric, 0.0) + weight
                merged[f"{metric}_lag_{k}"] = merged.get(f"{metric}_lag_{k}", 0.0) - weight
        return merged


def with_group_effect(rows: DataFrame, effects: DataFrame, group: str, name: str) -> DataFrame:
    """``rows`` with the effect (level, effect) of their group as a column, 0 where the group is unknown."""
    small = effects.select(F.col("level").alias("_level"), F.col("effect").alias("_found"))
    return rows.join(small, F.col(group) == F.col("_level"), "left").withColumn(name, F.coalesce("_found", F.lit(0.0))).drop("_level", "_found")


def matched_scenarios(percent: int, names: Mapping[str, float] = SCENARIOS) -> list[str]:
    """Decrease, constant and increase scenario for one percentage."""
    return [n for n, change in names.items() if change == 0 or round(abs(change) * 100) == percent]


def scenario_grid(df: DataFrame, scenarios: Mapping[str, float] = SCENARIOS) -> DataFrame:
    """Every row once per scenario, by exploding a literal: no join, no shuffle."""
    literal = F.array(
        *[F.struct(F.lit(n).alias("scenario"), F.lit(float(c)).alias("total_change")) for n, c in scenarios.items()]
    )
    return df.withColumn("_scenario", F.explode(literal)).select(
        "*", F.col("_scenario.scenario").alias("scenario"), F.col("_scenario.total_change").alias("total_change")
    ).drop("_scenario")


def forecast_history(panel: DataFrame) -> DataFrame:
    """Complete rows only; what is dropped here is a missing period to the forecast."""
    return drop_missing(panel.select(*HISTORY_COLUMNS, R.GROUP_CODE), HISTORY_COLUMNS)


def latest_state(history: DataFrame) -> DataFrame:
    """Per entity: its last period and the values at exactly 0..3 periods before it."""
    ordered = Window.partitionBy(R.ENTITY).orderBy(R.PERIOD)
    exactly = {
        f"{m}_t{k}": F.max(m).over(ordered.rangeBetween(-k, -k)) for m in (R.METRIC_A, R.METRIC_B) for k in (1, 2, 3)
    }
    return (
        history.withColumns({**exactly, "_next": F.lead(R.PERIOD).over(ordered)})
        .where(F.col("_next").isNull())
        .select(
            R.ENTITY, R.NAME, R.GROUP, R.GROUP_CODE, F.col(R.PERIOD).alias("last_period"),
            F.col("a").alias("a_t0"), "a_t1", "a_t2", "a_t3",
            F.col("b").alias("b_t0"), "b_t1", "b_t2", "b_t3", F.col("b2").alias("b2_t0"),
        )
    )


_STEP = (
    "struct<forecast_period:int,forecast_a:double,input_period:int,predicted_change:double,"
    "annualised_change:double,b_assumption:double,b2_assumption:double>"
)


def roll_forward(
    state: DataFrame,
    end_period: int,
    predictor: Predictor,
    predicts: str,
    scenarios: Mapping[str, float] = SCENARIOS,
    horizon: int = 3,
    low: float = 0.0,
    high: float = 100.0,
    group_effects: DataFrame | None = None,
) -> DataFrame:
    """Forecast every entity x scenario step by step from its own last period to ``end_period``.

    ``predicts="change"``: the predictor gives the change over ``horizon`` periods; one
    horizon-th of it is added to the current level. It needs the periods t, t-1 and t-3.
    ``predicts="level"``: the predictor gives the next level; it needs t, t-1, t-2 and t-3.
    A needed period that is absent ends the entity's forecast. The level is clipped, a
    predicted change is reported as it came. Supply follows the scenario's ramp and feeds the
    following step.

    Group effects, a table (level, effect) or the mapping of a ``LinearForm``, are joined to the state
    once and carried along: the plan is the same at any number of groups.
    """
    if predicts not in NEEDED:
        raise ValueError(f"predicts must be one of {list(NEEDED)}, not {predicts!r}")
    end = F.lit(end_period)
    needed = NEEDED[predicts]

    def step(past: Column, period: Column) -> Column:
        at = past.getField
        known = F.lit(True)
        for slot in needed:
            known = known & at(slot).isNotNull()
        features = {
            R.PERIOD: (period - 1).cast("double"),
            "a": at("a_t0"), "a_lag_1": at("a_t1"), "a_lag_2": at("a_t2"), "a_lag_3": at("a_t3"),
            "a_change_1": at("a_t0") - at("a_t1"), "a_change_3": at("a_t0") - at("a_t3"),
            "b": at("b_t0"), "b2": at("b2_t0"), "b_lag_1": at("b_t1"), "b_lag_3": at("b_t3"),
            "b_change_1": at("b_t0") - at("b_t1"), "b_change_3": at("b_t0") - at("b_t3"),
            R.GROUP: F.col(R.GROUP),
            GROUP_EFFECT: F.col("_effect"),
        }
        # From last + 1 to the end the ramp's progress is always within (0, 1].
        elapsed = (period - F.col("last_period")).cast("double") / (end - F.col("last_period")).cast("double")

        def advance(now: Column) -> Column:
            prediction, growth = now.getField("prediction"), now.getField("growth")
            per_step = prediction / F.lit(float(horizon))
            raw = at("a_t0") + per_step if predicts == "change" else prediction
            level = S.clip(raw, low, high)
            b_now, b2_now = F.col("b_t0") * growth, F.col("b2_t0") * growth
            record = F.struct(
                period.alias("forecast_period"),
                level.alias("forecast_a"),
                (period - 1).alias("input_period"),
                prediction.alias("predicted_change"),
                per_step.alias("annualised_change"),
                b_now.alias("b_assumption"),
                b2_now.alias("b2_assumption"),
            )
            return F.struct(
                level.alias("a_t0"), at("a_t0").alias("a_t1"), at("a_t1").alias("a_t2"), at("a_t2").alias("a_t3"),
                b_now.alias("b_t0"), at("b_t0").alias("b_t1"), at("b_t1").alias("b_t2"), at("b_t2").alias("b_t3"),
                b2_now.alias("b2_t0"), F.concat(at("steps"), F.array(record)).alias("steps"),
            )

        # A one-element transform names the step's prediction, so the model is evaluated once.
        growth = F.lit(1.0) + F.col("total_change") * elapsed
        now = F.struct(predictor(features).alias("prediction"), growth.alias("growth"))
        following = F.transform(F.array(now), advance).getItem(0)
        ended = past.withField("a_t0", F.lit(None).cast("double"))
        return F.when(known, following).otherwise(ended)

    begin = F.struct(
        *[F.col(f"{m}_t{k}").cast("double").alias(f"{m}_t{k}") for m in ("a", "b") for k in range(4)],
        F.col("b2_t0").cast("double").alias("b2_t0"),
        F.array().cast(f"array<{_STEP}>").alias("steps"),
    )
    # sequence() counts down when its end is before its start, so finished entities go first;
    # so do entities that lack a needed period already, before they are multiplied by scenarios.
    live = state.where(F.col("last_period") < end).dropna(subset=list(needed))
    if group_effects is None:
        known = list(getattr(predictor, "group_effects", {}).items())
        group_effects = state.sparkSession.createDataFrame(known, "level string, effect double") if known else None
    live = live.withColumn("_effect", F.lit(0.0)) if group_effects is None else with_group_effect(live, group_effects, R.GROUP, "_effect")
    folded = scenario_grid(live, scenarios).withColumn(
        "_steps", F.aggregate(F.sequence(F.col("last_period") + 1, end), begin, step, lambda s: s.getField("steps"))
    )
    columns = [R.ENTITY, R.NAME, R.GROUP, R.GROUP_CODE, "scenario", "total_change"]
    rows = folded.select(*columns, F.inline("_steps"))
    return rows if predicts == "change" else rows.drop("predicted_change", "annualised_change")


def emit_window(forecast: DataFrame, first_period: int) -> DataFrame:
    """Drop the steps before the reporting window; they were needed to get there."""
    return forecast.where(F.col("forecast_period") >= first_period)


def require_forecast(forecast: DataFrame) -> DataFrame:
    return require_rows(forecast, "no forecasts were created; check the history's coverage")


def scenario_series(forecast: DataFrame, scenarios: Sequence[str]) -> DataFrame:
    return forecast.where(F.col("scenario").isin(list(scenarios))).orderBy(R.ENTITY, "scenario", "forecast_period")


def impact_vs_constant(forecast: DataFrame, final_period: int, constant: str = CONSTANT) -> DataFrame:
    """Each scenario's final value minus the entity's constant-scenario value.

    A window over the handful of scenarios of one entity; entities lacking the constant
    scenario get NULL.
    """
    per_entity = Window.partitionBy(R.ENTITY)
    base = F.max(F.when(F.col("scenario") == constant, F.col("forecast_a"))).over(per_entity)
    return (
        forecast.where(F.col("forecast_period") == final_period)
        .withColumn("constant_a", base)
        .withColumn("impact", F.col("forecast_a") - F.col("constant_a"))
    )


def scenario_spread(forecast: DataFrame, final_period: int) -> DataFrame:
    return (
        forecast.where(F.col("forecast_period") == final_period)
        .groupBy(R.ENTITY)
        .agg((F.max("forecast_a") - F.min("forecast_a")).alias("spread"))
    )


def top_forecast(forecast: DataFrame, scenario: str, final_period: int, k: int = 10) -> DataFrame:
    """Top k at the final period, shown in ascending order."""
    picked = forecast.where((F.col("scenario") == scenario) & (F.col("forecast_period") == final_period))
    top = picked.orderBy(F.desc_nulls_last("forecast_a"), R.ENTITY).limit(k)
    return top.orderBy(F.asc("forecast_a"), R.ENTITY)
