"""The analytical views over the two base tables, under the names their users query."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from paneloom import roles as R
from paneloom.operators import clean, features, panel, ranking, summary
from paneloom.store import materialise

# Column names of the base tables and views.
SPEC = R.PanelSpec(
    entity="iso3",
    name="country",
    period="year",
    category="sex",
    category_code="sex_code",
    a="obesity_pct",
    a_low="obesity_pct_low",
    a_high="obesity_pct_high",
    b="sugar_supply_kg_per_capita",
    b2="sugar_supply_kcal_per_capita_day",
    grp="who_region",
    grp_code="who_region_code",
)
ALL_CATEGORIES, FIRST, SECOND = "Both sexes", "Female", "Male"
_BOUNDS = {"start_period": "start_year", "end_period": "end_year"}
_SPAN_A = {
    "a_start": "obesity_start_pct",
    "a_latest": "obesity_latest_pct",
    "a_span_change": "obesity_change_pct_points",
}
_SPAN_B = {
    "b_start": "sugar_start_kg_per_capita",
    "b_latest": "sugar_latest_kg_per_capita",
    "b_span_change": "sugar_change_kg_per_capita",
}
_PANEL = {
    "a_rank": "obesity_rank_in_year",
    "b_rank": "sugar_rank_in_year",
    "a_change": "obesity_change_from_previous_year",
    "b_change": "sugar_change_from_previous_year",
}
_FEATURES = {
    "a_lag_1": "obesity_lag_1",
    "a_lag_2": "obesity_lag_2",
    "a_lag_3": "obesity_lag_3",
    "b_lag_1": "sugar_lag_1",
    "b_lag_3": "sugar_lag_3",
    "a_change_1": "obesity_change_1yr",
    "a_change_3": "obesity_change_3yr",
    "b_change_1": "sugar_change_1yr",
    "b_change_3": "sugar_change_3yr",
    "a_future_3": "obesity_future_3yr",
    "target_a_next": "target_obesity_next_year",
    "target_a_change_3": "target_obesity_change_3yr",
}
# Scenario forecasts: SPEC.from_roles(forecast, FORECAST).
FORECAST = {
    "total_change": "total_sugar_change_by_2030",
    "forecast_period": "forecast_year",
    "forecast_a": "forecast_obesity_pct",
    "input_period": "input_year",
    "predicted_change": "predicted_obesity_change_3yr",
    "annualised_change": "predicted_annualized_change",
    "b_assumption": "sugar_supply_kg_per_capita_assumption",
    "b2_assumption": "sugar_supply_kcal_per_capita_day_assumption",
}


# View name -> the method of ``Views`` that builds it.
VIEWS = {
    "v_obesity_country_year": "obesity_country_year",
    "v_obesity_latest_country": "obesity_latest_country",
    "v_obesity_country_change": "obesity_country_change",
    "v_obesity_region_summary_latest": "obesity_region_summary_latest",
    "v_obesity_sex_gap_latest": "obesity_sex_gap_latest",
    "v_sugar_obesity_country_year": "sugar_obesity_country_year",
    "v_sugar_obesity_latest": "sugar_obesity_latest",
    "v_sugar_obesity_region_summary": "sugar_obesity_region_summary",
    "v_sugar_obesity_country_change": "sugar_obesity_country_change",
    "v_ml_obesity_features": "ml_obesity_features",
    "v_ml_sugar_sensitivity_features": "ml_sugar_sensitivity_features",
}


class Views:
    """A snapshot of the views; a frame is built when it is first asked for.

    The joined panel is stored once and shared by its readers, so the views show the base tables as they
    were then: make a new ``Views`` after a reload. ``keys_are_unique`` says that both tables hold each of
    their keys once, as after a ``full_refresh`` with a key; it saves a shuffle by entity.
    """

    def __init__(self, who_obesity: DataFrame, faostat_sugar_supply: DataFrame, keys_are_unique: bool = False):
        self.observations = SPEC.to_roles(who_obesity)
        self.supply = SPEC.to_roles(faostat_sugar_supply)
        self.keys_are_unique = keys_are_unique

    @cached_property
    def _slice(self) -> DataFrame:
        return clean.category_slice(self.observations, R.CATEGORY, ALL_CATEGORIES, [R.CATEGORY, R.CATEGORY_CODE])

    @cached_property
    def _panel(self) -> DataFrame:
        return materialise(panel.add_changes(panel.panel_join(self._slice, self.supply)), "panel")

    def obesity_country_year(self) -> DataFrame:
        return SPEC.from_roles(self._slice)

    def obesity_latest_country(self) -> DataFrame:
        latest = materialise(panel.latest_snapshot(self._slice), "latest")
        return SPEC.from_roles(ranking.add_ranks(latest, {"a_rank": "a"}), {"a_rank": "obesity_rank"})

    def obesity_country_change(self) -> DataFrame:
        change = materialise(panel.span_change(self._slice, ["a"], [R.GROUP, R.GROUP_CODE]), "change")
        ranked = ranking.add_ranks(change, {"rank": "a_span_change"})
        return SPEC.from_roles(ranked, {**_BOUNDS, **_SPAN_A, "rank": "increase_rank"})

    def obesity_region_summary_latest(self) -> DataFrame:
        names = {
            "entities": "countries_or_areas",
            "avg_a": "avg_obesity_pct",
            "min_a": "min_obesity_pct",
            "max_a": "max_obesity_pct",
        }
        return SPEC.from_roles(summary.group_range(panel.latest_snapshot(self._slice), "a"), names)

    def obesity_sex_gap_latest(self) -> DataFrame:
        gap = panel.category_gap(
            self.observations, FIRST, SECOND, "a", [R.GROUP, R.GROUP_CODE], panel.latest_period(self.observations)
        )
        names = {
            "first_value": "female_obesity_pct",
            "second_value": "male_obesity_pct",
            "gap": "female_minus_male_gap",
        }
        return SPEC.from_roles(gap, names)

    def _ranked(self, rows: DataFrame) -> DataFrame:
        ranked = ranking.add_ranks(rows, {"a_rank": "a", "b_rank": "b"}, [R.PERIOD])
        order = [R.ENTITY, R.NAME, R.PERIOD, "a", R.METRIC_A_LOW, R.METRIC_A_HIGH, "b", "b2", R.GROUP, R.GROUP_CODE]
        return SPEC.from_roles(ranked.select(*order, *_PANEL), _PANEL)

    def sugar_obesity_country_year(self) -> DataFrame:
        return self._ranked(self._panel)

    def sugar_obesity_latest(self) -> DataFrame:
        """Ranks are within a period, so only the last one's rows are ranked."""
        return self._ranked(panel.latest_snapshot(self._panel))

    def sugar_obesity_region_summary(self) -> DataFrame:
        names = {
            "entities": "countries",
            "avg_a": "avg_obesity_pct",
            "avg_b": "avg_sugar_kg_per_capita",
            "avg_b2": "avg_sugar_kcal_per_capita_day",
            "corr_b_a": "sugar_obesity_corr",
        }
        return SPEC.from_roles(summary.group_summary(self._panel, self.keys_are_unique), names)

    def sugar_obesity_country_change(self) -> DataFrame:
        change = panel.span_change(self._panel, ["a", "b"], [R.NAME, R.GROUP, R.GROUP_CODE])
        ranked = ranking.add_ranks(materialise(change, "change"), {"rank": "a_span_change"})
        return SPEC.from_roles(ranked, {**_BOUNDS, **_SPAN_A, **_SPAN_B, "rank": "obesity_increase_rank"})

    def ml_obesity_features(self) -> DataFrame:
        return SPEC.from_roles(features.next_period_features(self._panel), _FEATURES)

    def ml_sugar_sensitivity_features(self) -> DataFrame:
        return SPEC.from_roles(features.change_features(self._panel), _FEATURES)

    def view(self, name: str) -> DataFrame:
        return getattr(self, VIEWS[name])()

    def all(self) -> dict[str, DataFrame]:
        return {name: self.view(name) for name in VIEWS}

    def register(self, *names: str) -> list[str]:
        """Make the named views (all, if none is named) and the two base tables available to SQL."""
        views = {name: self.view(name) for name in names or VIEWS}
        views["who_obesity"] = SPEC.from_roles(self.observations)
        views["faostat_sugar_supply"] = SPEC.from_roles(self.supply)
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        return sorted(views)

    def exports(self) -> dict[str, DataFrame]:
        """The four views a dashboard reads."""
        return {
            "dashboard_latest": self.sugar_obesity_latest(),
            "dashboard_country_year": self.sugar_obesity_country_year(),
            "dashboard_region_summary": self.sugar_obesity_region_summary(),
            "dashboard_country_change": self.sugar_obesity_country_change(),
        }
