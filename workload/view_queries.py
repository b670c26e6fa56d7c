"""The analytical views under their users' column names, over base tables derived from the given ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from paneloom import roles as R
from paneloom.operators import features as FE
from paneloom.plans.views import SPEC, VIEWS, Views
from workload import fixtures as X
from workload.common import Registry, tidy
from workload.model_queries import CHANGE_COLUMNS, CHANGE_FEATURES, LEVEL_COLUMNS, LEVEL_FEATURES
from workload.panel_queries import CORRELATION, RANKED
from workload.sql import observations_cte, panel_cte, r, slice_cte, with_

registry = Registry()

# What the base table of prevalence calls the categories.
SEXES = {X.ALL: "Both sexes", "1-URGENT": "Female", "5-LOW": "Male"}


def base_tables(spark, folder):
    """Customer x year: prevalence in three categories and more, and supply with the entity's name."""
    label = F.create_map(*[F.lit(v) for pair in SEXES.items() for v in pair])
    seen = X.observations(spark, folder)
    seen = seen.withColumn(R.CATEGORY, F.coalesce(label[F.col(R.CATEGORY_CODE)], F.col(R.CATEGORY)))
    names = X.entity_dims(spark, folder).select(R.ENTITY, R.NAME)
    return SPEC.from_roles(seen), SPEC.from_roles(X.supply(spark, folder).join(names, R.ENTITY))


SLICE = f"""{slice_cte()}, dims as (
  select c_custkey as entity, r_name as grp, cast(r_regionkey as bigint) as grp_code
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
seen as (select s.*, d.grp, d.grp_code from slice s join dims d using (entity)),
latest as (select * from seen where period = (select max(period) from seen))"""
PANEL = panel_cte()
GROUP = "grp as who_region, grp_code as who_region_code"
KEY = "entity as iso3, period as year"


def columns(*pairs):
    """``role as user name`` for doubles on the comparison grid."""
    return ", ".join(f"{r(value)} as {name}" for value, name in pairs)


SHARE = columns(("a", "obesity_pct"), ("a_low", "obesity_pct_low"), ("a_high", "obesity_pct_high"))
SUPPLY = columns(("b", "sugar_supply_kg_per_capita"), ("b2", "sugar_supply_kcal_per_capita_day"))
CORE = f"""{KEY}, name as country, {SHARE}, {SUPPLY}, {GROUP}, a_rank as obesity_rank_in_year, b_rank as sugar_rank_in_year,
  {columns(('a_change', 'obesity_change_from_previous_year'), ('b_change', 'sugar_change_from_previous_year'))}"""


def ends(source):
    """First and last period of ``source``, and the entities that have both."""
    return f"""ends as (select min(period) as first_period, max(period) as last_period from {source}),
spans as (select f.entity, first_period, last_period, f.a as a_start, l.a as a_latest, l.grp, l.grp_code,
    {'l.name, f.b as b_start, l.b as b_latest,' if source == 'panel' else ''} l.a - f.a as a_change
  from ends join {source} f on f.period = first_period join {source} l on l.period = last_period and l.entity = f.entity)"""


SPAN = f"""entity as iso3, first_period as start_year, last_period as end_year, {GROUP},
  {columns(('a_start', 'obesity_start_pct'), ('a_latest', 'obesity_latest_pct'), ('a_change', 'obesity_change_pct_points'))}"""
SPAN_RANK = "rank() over (order by a_change desc nulls first)"
NAMED = {
    "a": "obesity_pct", "b": "sugar_supply_kg_per_capita", "b2": "sugar_supply_kcal_per_capita_day",
    "a_lag_1": "obesity_lag_1", "a_lag_2": "obesity_lag_2", "a_lag_3": "obesity_lag_3", "b_lag_1": "sugar_lag_1",
    "b_lag_3": "sugar_lag_3", "a_change_1": "obesity_change_1yr", "a_change_3": "obesity_change_3yr",
    "b_change_1": "sugar_change_1yr", "b_change_3": "sugar_change_3yr", "a_future_3": "obesity_future_3yr",
    FE.LEVEL_TARGET: "target_obesity_next_year", FE.CHANGE_TARGET: "target_obesity_change_3yr",
}


def feature_columns(names):
    return f"{KEY}, name as country, {GROUP}, " + columns(*[(c, NAMED[c]) for c in names])


SQL = {
    "v_obesity_country_year": with_(SLICE) + f"select {KEY}, {SHARE}, {GROUP} from seen",
    "v_obesity_latest_country": with_(SLICE)
    + f"select {KEY}, {SHARE}, {GROUP}, rank() over (order by a desc nulls first) as obesity_rank from latest",
    "v_obesity_country_change": with_(SLICE, ends("seen")) + f"select {SPAN}, {SPAN_RANK} as increase_rank from spans",
    "v_obesity_region_summary_latest": with_(SLICE)
    + f"""select grp as who_region, period as year, count(distinct entity) as countries_or_areas,
  {columns(('avg(a)', 'avg_obesity_pct'), ('min(a)', 'min_obesity_pct'), ('max(a)', 'max_obesity_pct'))} from latest group by grp, period""",
    "v_obesity_sex_gap_latest": with_(observations_cte())
    + f"""select f.entity as iso3, f.period as year, {columns(('f.a', 'female_obesity_pct'), ('m.a', 'male_obesity_pct'), ('f.a - m.a', 'female_minus_male_gap'))},
  f.grp as who_region, f.grp_code as who_region_code
from observations f join observations m on m.entity = f.entity and m.period = f.period
where f.category_code = '1-URGENT' and m.category_code = '5-LOW' and f.period = (select max(period) from observations)""",
    "v_sugar_obesity_country_year": with_(PANEL, RANKED) + f"select {CORE} from ranked",
    "v_sugar_obesity_latest": with_(PANEL, RANKED)
    + f"select {CORE} from ranked where period = (select max(period) from ranked)",
    "v_sugar_obesity_region_summary": with_(PANEL)
    + f"""select grp as who_region, period as year, count(distinct entity) as countries,
  {columns(('avg(a)', 'avg_obesity_pct'), ('avg(b)', 'avg_sugar_kg_per_capita'), ('avg(b2)', 'avg_sugar_kcal_per_capita_day'))},
  {r(CORRELATION)} as sugar_obesity_corr from panel group by grp, period""",
    "v_sugar_obesity_country_change": with_(PANEL, ends("panel"))
    + f"""select {SPAN}, name as country, {columns(('b_start', 'sugar_start_kg_per_capita'), ('b_latest', 'sugar_latest_kg_per_capita'),
  ('b_latest - b_start', 'sugar_change_kg_per_capita'))}, {SPAN_RANK} as obesity_increase_rank from spans""",
    "v_ml_obesity_features": with_(PANEL, LEVEL_FEATURES) + f"select {feature_columns(LEVEL_COLUMNS)} from level_features",
    "v_ml_sugar_sensitivity_features": with_(PANEL, CHANGE_FEATURES)
    + f"select {feature_columns(CHANGE_COLUMNS)} from change_features",
}


def _register(view):
    @registry.add(view.replace("v_", "view_", 1), SQL[view])
    def query(spark, folder):
        return tidy(Views(*base_tables(spark, folder), keys_are_unique=True).view(view))

    query.__doc__ = f"``{view}`` over the derived base tables."


for _view in VIEWS:
    _register(_view)
