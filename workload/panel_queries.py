"""Panel, window, join, aggregate and top-k queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from paneloom import roles as R
from paneloom.functions import scalars as S
from paneloom.operators import clean as C
from paneloom.operators import panel as P
from paneloom.operators import quality as Q
from paneloom.operators import ranking as RK
from paneloom.operators import summary as SM
from paneloom.sources import tables as T
from paneloom.store import materialise, new_path
from workload import fixtures as X
from workload.common import Registry, tidy
from workload.sql import observations_cte, panel_cte, r, shown, slice_cte, supply_cte, with_

registry = Registry()
add = registry.add

PANEL = panel_cte()
OBSERVATIONS = observations_cte()
SLICE = slice_cte()
PANEL_COLUMNS = f"entity, name, period, {r('a')} as a, {r('a_low')} as a_low, {r('a_high')} as a_high, b, {r('b2')} as b2, grp, grp_code"
GROUPS = ["ASIA", "EUROPE", "AFRICA"]
GROUP_LIST = "('ASIA', 'EUROPE', 'AFRICA')"


def stored_panel(spark, folder, *columns):
    """The columns wanted of the panel as a stored table, for operators that read it more than once."""
    return materialise(X.panel(spark, folder).select(*columns), "panel")


# ---- the panel itself ---------------------------------------------------------------------


@add("panel_join", with_(PANEL) + f"select {PANEL_COLUMNS} from panel")
def panel_join(spark, folder):
    return tidy(X.panel(spark, folder))


RANKED = """ranked as (select *,
    rank() over (partition by period order by a desc nulls first) as a_rank,
    rank() over (partition by period order by b desc nulls first) as b_rank,
    a - lag(a) over (partition by entity order by period) as a_change,
    b - lag(b) over (partition by entity order by period) as b_change from panel)"""


@add(
    "panel_core",
    with_(PANEL, RANKED) + f"select {PANEL_COLUMNS}, a_rank, b_rank, {r('a_change')} as a_change, b_change from ranked",
)
def panel_core(spark, folder):
    """Changes while the rows are together by entity; then stored, then ranked by period."""
    changed = materialise(P.add_changes(X.panel(spark, folder)), "panel")
    return tidy(RK.add_ranks(changed, {"a_rank": "a", "b_rank": "b"}, [R.PERIOD]))


@add("rank_in_period", with_(PANEL, RANKED) + "select entity, period, a_rank, b_rank from ranked")
def rank_in_period(spark, folder):
    """The sliced ranking, as it runs when a period is too large for one task."""
    panel = materialise(X.panel(spark, folder).select(*R.KEY, "a", "b"), "panel")
    ranked = RK.add_ranks(panel, {"a_rank": "a", "b_rank": "b"}, [R.PERIOD])
    return tidy(ranked.drop("a", "b"))


@add("change_prev", with_(PANEL, RANKED) + f"select entity, period, {r('a_change')} as a_change, b_change from ranked")
def change_prev(spark, folder):
    return tidy(P.add_changes(X.panel(spark, folder)).select(*R.KEY, "a_change", "b_change"))


@add(
    "rank_global",
    with_(SLICE)
    + f"""select entity, period, {r('a')} as a, rank() over (order by a desc nulls first) as a_rank
from slice where period = (select max(period) from slice)""",
)
def rank_global(spark, folder):
    newest = P.latest_snapshot(X.all_orders(spark, folder), X.order_periods(spark, folder))
    latest = materialise(newest.select(*R.KEY, "a"), "latest")
    return tidy(RK.add_ranks(latest, {"a_rank": "a"}))


@add(
    "rank_global_scaled",
    """select o_orderkey, rank() over (order by o_totalprice desc nulls first) as price_rank,
  rank() over (order by year(o_orderdate) desc nulls first) as year_rank from orders""",
)
def rank_global_scaled(spark, folder):
    orders = X.table(spark, folder, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("order_year")
    )
    ranks = {"price_rank": "o_totalprice", "year_rank": "order_year"}
    ranked = RK.add_ranks(orders, ranks)
    return tidy(ranked.select("o_orderkey", *ranks))


@add(
    "rank_wide_values",
    """select o_orderkey,
  rank() over (partition by o_orderpriority order by 9007199254740992 + o_custkey desc nulls first) as key_rank,
  rank() over (partition by o_orderpriority order by 12345678901234567890::decimal(38,0) * 1000000 + (o_orderkey % 5000) desc nulls first) as wide_rank
from orders""",
)
def rank_wide_values(spark, folder):
    """Whole numbers that no double can tell apart."""
    orders = X.table(spark, folder, "orders").select(
        "o_orderkey", "o_orderpriority",
        (F.lit(2**53) + F.col("o_custkey")).alias("wide_key"),
        F.expr("cast(12345678901234567890000000BD + (o_orderkey % 5000) as decimal(38,0))").alias("wide"),
    )
    ranks = {"key_rank": "wide_key", "wide_rank": "wide"}
    return tidy(RK.add_ranks(orders, ranks, ["o_orderpriority"]).select("o_orderkey", *ranks))


@add(
    "lag_features",
    with_(PANEL)
    + f"""select entity, period, {', '.join(r(f'lag(a, {k}) over w') + f' as a_lag_{k}' for k in (1, 2, 3))},
  lag(b, 1) over w as b_lag_1, lag(b, 3) over w as b_lag_3
from panel window w as (partition by entity order by period)""",
)
def lag_features(spark, folder):
    shifts = {"a_lag_1": ("a", 1), "a_lag_2": ("a", 2), "a_lag_3": ("a", 3), "b_lag_1": ("b", 1), "b_lag_3": ("b", 3)}
    return tidy(P.row_offsets(X.panel(spark, folder), shifts).select(*R.KEY, *shifts))


@add(
    "lead_target",
    with_(PANEL)
    + f"""select entity, period, {r('lead(a, 1) over w')} as a_lead_1, {r('lead(a, 3) over w')} as a_lead_3
from panel window w as (partition by entity order by period)""",
)
def lead_target(spark, folder):
    shifts = {"a_lead_1": ("a", -1), "a_lead_3": ("a", -3)}
    return tidy(P.row_offsets(X.panel(spark, folder), shifts).select(*R.KEY, *shifts))


@add(
    "calendar_lag_lookup",
    with_(PANEL)
    + f"""select p.entity, p.period, {', '.join(r(f'q{k}.a') + f' as a_back_{k}, q{k}.b as b_back_{k}' for k in (1, 2, 3))}
from panel p {' '.join(f'left join panel q{k} on q{k}.entity = p.entity and q{k}.period = p.period - {k}' for k in (1, 2, 3))}""",
)
def calendar_lag_lookup(spark, folder):
    shifts = {f"{m}_back_{k}": (m, k) for m in ("a", "b") for k in (1, 2, 3)}
    return tidy(P.calendar_offsets(X.panel(spark, folder), shifts).select(*R.KEY, *shifts))


# ---- bounds, snapshots, span changes ------------------------------------------------------


@add("period_bounds", with_(PANEL) + "select min(period) as start_period, max(period) as end_period from panel")
def period_bounds(spark, folder):
    return tidy(P.period_bounds(X.panel(spark, folder)))


@add(
    "latest_snapshot",
    with_(PANEL, RANKED)
    + f"""select {PANEL_COLUMNS}, a_rank, b_rank, {r('a_change')} as a_change, b_change
from ranked where period = (select max(period) from ranked)""",
)
def latest_snapshot(spark, folder):
    """The core view restricted to its last period; only that period needs ranking."""
    panel = materialise(P.add_changes(X.panel(spark, folder)), "panel")
    latest = P.latest_snapshot(panel)
    return tidy(RK.add_ranks(latest, {"a_rank": "a", "b_rank": "b"}, [R.PERIOD]))


@add(
    "bounds_cross_join",
    with_(SLICE)
    + f"""select s.entity, s.period, {r('s.a')} as a, y.start_period, y.end_period
from slice s cross join (select min(period) as start_period, max(period) as end_period from slice) y
where s.period = y.start_period or s.period = y.end_period""",
)
def bounds_cross_join(spark, folder):
    rows = X.all_orders(spark, folder).select(*R.KEY, "a")
    periods = X.order_periods(spark, folder)
    bounded = rows.withColumns({"start_period": P.first_period(periods), "end_period": P.latest_period(periods)})
    return tidy(bounded.where((F.col(R.PERIOD) == F.col("start_period")) | (F.col(R.PERIOD) == F.col("end_period"))))


SPAN_SLICES = """bounds as (select min(period) as start_period, max(period) as end_period from {source}),
start_rows as (select p.* from {source} p cross join bounds y where p.period = y.start_period),
end_rows as (select p.* from {source} p cross join bounds y where p.period = y.end_period)"""


@add(
    "span_change",
    with_(SLICE, SPAN_SLICES.format(source="slice"))
    + f"""select e.entity, s.period as start_period, e.period as end_period, {r('s.a')} as a_start, {r('e.a')} as a_latest,
  {r('e.a - s.a')} as a_span_change, rank() over (order by e.a - s.a desc nulls first) as change_rank
from end_rows e join start_rows s on e.entity = s.entity""",
)
def span_change(spark, folder):
    periods = X.order_periods(spark, folder)
    rows = X.all_orders(spark, folder)
    change = P.span_change(rows, ["a"], start=P.first_period(periods), end=P.latest_period(periods))
    change = materialise(change, "change")
    return tidy(RK.add_ranks(change, {"change_rank": "a_span_change"}))


@add(
    "span_change_two_metrics",
    with_(PANEL, SPAN_SLICES.format(source="panel"))
    + f"""select e.entity, e.name, e.grp, e.grp_code, s.period as start_period, e.period as end_period,
  {r('s.a')} as a_start, {r('e.a')} as a_latest, {r('e.a - s.a')} as a_span_change,
  s.b as b_start, e.b as b_latest, e.b - s.b as b_span_change,
  rank() over (order by e.a - s.a desc nulls first) as change_rank
from end_rows e join start_rows s on e.entity = s.entity""",
)
def span_change_two_metrics(spark, folder):
    change = P.span_change(
        stored_panel(spark, folder, *R.KEY, R.NAME, "a", "b", R.GROUP, R.GROUP_CODE),
        ["a", "b"],
        [R.NAME, R.GROUP, R.GROUP_CODE],
    )
    return tidy(RK.add_ranks(materialise(change, "change"), {"change_rank": "a_span_change"}))


@add(
    "span_change_join",
    with_(SLICE)
    + f"""select e.entity, {r('s.a')} as a_start, {r('e.a')} as a_latest, {r('e.a - s.a')} as a_span_change
from slice e join slice s on e.entity = s.entity
where s.period = (select min(period) from slice) and e.period = (select max(period) from slice)""",
)
def span_change_join(spark, folder):
    periods = X.order_periods(spark, folder)
    return tidy(P.slice_join(X.all_orders(spark, folder), "a", P.first_period(periods), P.latest_period(periods)))


@add(
    "span_change_fixed",
    with_(SLICE)
    + f"""select e.entity, 1996::bigint as start_period, 2000::bigint as end_period, {r('s.a')} as a_start, {r('e.a')} as a_latest,
  {r('e.a - s.a')} as a_span_change
from slice e join slice s on e.entity = s.entity where s.period = 1996 and e.period = 2000""",
)
def span_change_fixed(spark, folder):
    return tidy(P.span_change(X.all_orders(spark, folder), ["a"], start=1996, end=2000))


@add(
    "category_gap_latest",
    with_(OBSERVATIONS)
    + f"""select f.entity, f.period, {r('f.a')} as first_value, {r('m.a')} as second_value, {r('f.a - m.a')} as gap,
  f.grp, f.grp_code
from observations f join observations m on f.entity = m.entity and f.period = m.period
cross join (select max(period) as period from observations) ly
where f.category = 'Urgent' and m.category = 'Low' and f.period = ly.period""",
)
def category_gap_latest(spark, folder):
    rows = X.observations(spark, folder)
    newest = P.latest_period(X.order_periods(spark, folder))
    return tidy(P.category_gap(rows, "Urgent", "Low", "a", [R.GROUP, R.GROUP_CODE], newest))


# ---- aggregates ---------------------------------------------------------------------------


@add(
    "count_min_max_by_category",
    with_(OBSERVATIONS)
    + """select category, count(*) as row_count, min(period) as min_period, max(period) as max_period
from observations group by category""",
)
def count_min_max_by_category(spark, folder):
    return tidy(SM.count_min_max(X.observations(spark, folder), R.CATEGORY, R.PERIOD))


@add(
    "group_avg_fixed_period",
    with_(OBSERVATIONS)
    + f"""select grp, {shown('avg(a)', 2)} as avg_a from observations
where period = 2000 and category = 'All orders' group by grp order by avg_a desc nulls first, grp""",
)
def group_avg_fixed_period(spark, folder):
    rows = C.at_point(X.observations(spark, folder), period=2000, category="All orders")
    return tidy(SM.group_average(rows, R.GROUP, "a"))


@add(
    "group_summary_latest",
    with_(OBSERVATIONS)
    + f"""select grp, period, count(distinct entity) as entities, {r('avg(a)')} as avg_a, {r('min(a)')} as min_a, {r('max(a)')} as max_a
from observations where category = 'All orders'
  and period = (select max(period) from observations where category = 'All orders') group by grp, period""",
)
def group_summary_latest(spark, folder):
    rows = C.category_slice(X.observations(spark, folder), R.CATEGORY, "All orders", [R.CATEGORY, R.CATEGORY_CODE])
    return tidy(SM.group_range(P.latest_snapshot(rows, X.order_periods(spark, folder)), "a"))


CORRELATION = "regr_sxy(b, a) / sqrt(nullif(regr_sxx(b, a) * regr_syy(b, a), 0))"
GROUP_SUMMARY = f"""group_summary as (select grp, period, count(distinct entity) as entities, avg(a) as avg_a,
  avg(b) as avg_b, avg(b2) as avg_b2, {CORRELATION} as corr_b_a from panel group by grp, period)"""


@add(
    "group_summary_corr",
    with_(PANEL, GROUP_SUMMARY)
    + f"""select grp, period, entities, {', '.join(r(c) + f' as {c}' for c in ('avg_a', 'avg_b', 'avg_b2', 'corr_b_a'))}
from group_summary""",
)
def group_summary_corr(spark, folder):
    return tidy(SM.group_summary(X.panel(spark, folder)))


@add(
    "unpivot_metrics",
    with_(PANEL, GROUP_SUMMARY)
    + f"""select grp, metric, {r('value')} as value from (
  select grp, 'Average share (%)' as metric, avg_a as value from group_summary
    where period = (select max(period) from group_summary) and grp in {GROUP_LIST}
  union all select grp, 'Average supply', avg_b from group_summary
    where period = (select max(period) from group_summary) and grp in {GROUP_LIST})""",
)
def unpivot_metrics(spark, folder):
    summary = materialise(SM.group_summary(X.panel(spark, folder)), "summary")
    latest = C.keep_groups(P.latest_snapshot(summary), R.GROUP, GROUPS)
    return tidy(SM.unpivot_metrics(latest, [R.GROUP], {"avg_a": "Average share (%)", "avg_b": "Average supply"}))


@add(
    "kpi_cards",
    with_(PANEL)
    + f"""select max(period) as latest_period, count(distinct entity) as entities, {r('avg(a)')} as avg_a, {r('avg(b)')} as avg_b
from panel where period = (select max(period) from panel) and grp in {GROUP_LIST}""",
)
def kpi_cards(spark, folder):
    latest = P.latest_snapshot(stored_panel(spark, folder, *R.KEY, "a", "b", R.GROUP))
    return tidy(SM.kpis(C.keep_groups(latest, R.GROUP, GROUPS)))


@add(
    "kpi_formatted",
    with_(PANEL)
    + f"""select cast(max(period) as varchar) as latest_period, format('{{:,}}', count(distinct entity)) as entities,
  printf('%.2f%%', avg(a)) as avg_a, printf('%.2f', avg(b)) as avg_b, format('{{:,}}', cast(sum(b) as bigint)) as total_b
from panel where grp in {GROUP_LIST}""",
)
def kpi_formatted(spark, folder):
    rows = C.keep_groups(X.panel(spark, folder), R.GROUP, GROUPS)
    numbers = rows.agg(*SM.kpi_aggregates(), F.sum("b").alias("total_b"))
    return numbers.select(
        F.col("latest_period").cast("string").alias("latest_period"),
        S.thousands(F.col("entities")).alias("entities"),
        S.percent_text(F.col("avg_a")).alias("avg_a"),
        F.format_string("%.2f", F.col("avg_b")).alias("avg_b"),
        S.thousands(F.col("total_b")).alias("total_b"),
    )


@add(
    "group_trendline",
    with_(PANEL)
    + f"""select grp, period, cast(regr_count(a, b) as bigint) as n, {r('regr_sxy(a, b) / nullif(regr_sxx(a, b), 0)')} as slope,
  {r('regr_avgy(a, b) - regr_sxy(a, b) / nullif(regr_sxx(a, b), 0) * regr_avgx(a, b)')} as intercept,
  {r('regr_sxy(a, b) * regr_sxy(a, b) / nullif(regr_sxx(a, b) * regr_syy(a, b), 0)')} as r2
from panel group by grp, period""",
)
def group_trendline(spark, folder):
    return tidy(SM.trendline(X.panel(spark, folder), [R.GROUP, R.PERIOD], "a", "b"))


@add(
    "distinct_options",
    with_(PANEL)
    + """select entity, name, name || ' (' || cast(entity as varchar) || ')' as label
from (select distinct entity, name from panel) order by name, entity""",
)
def distinct_options(spark, folder):
    return tidy(C.options(X.panel(spark, folder), R.ENTITY, R.NAME))


@add("distinct_groups", with_(PANEL) + "select distinct grp from panel where period = (select max(period) from panel) order by grp")
def distinct_groups(spark, folder):
    return SM.distinct_values(P.latest_snapshot(stored_panel(spark, folder, R.PERIOD, R.GROUP)), R.GROUP)


@add(
    "label_options",
    """select r_name, n_name, n_name || ' (' || cast(n_nationkey as varchar) || ')' as label, count(*) as customers
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
group by r_name, n_name, n_nationkey""",
)
def label_options(spark, folder):
    counted = X.table(spark, folder, "customer").groupBy("c_nationkey").agg(F.count("*").alias("customers"))
    nation = X.table(spark, folder, "nation").join(
        X.table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    named = counted.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return tidy(
        named.select(
            "r_name", "n_name", S.entity_label(F.col("n_name"), F.col("n_nationkey")).alias("label"), "customers"
        )
    )


@add("filter_groups", with_(PANEL) + f"select {PANEL_COLUMNS} from panel where grp in {GROUP_LIST}")
def filter_groups(spark, folder):
    return tidy(C.keep_groups(X.panel(spark, folder), R.GROUP, GROUPS))


# ---- top-k and series ---------------------------------------------------------------------


@add(
    "topk_sql",
    with_(OBSERVATIONS)
    + f"""select entity, {shown('a', 2)} as a, grp from observations where period = 2000 and category = 'All orders'
order by a desc nulls first, entity limit 10""",
)
def topk_sql(spark, folder):
    rows = C.at_point(X.observations(spark, folder), period=2000, category="All orders")
    shown = SM.rounded(rows.select(R.ENTITY, "a", R.GROUP), {"a": 2}, half_even=False)
    return tidy(SM.top_k(shown, "a", 10, [R.ENTITY], nulls_first=True))


@add(
    "topk_change",
    with_(SLICE)
    + f"""select e.entity, {shown('s.a', 2)} as a_start, {shown('e.a', 2)} as a_latest, {shown('e.a - s.a', 2)} as a_span_change
from slice e join slice s on e.entity = s.entity where s.period = 1996 and e.period = 2000
order by a_span_change desc nulls first, e.entity limit 10""",
)
def topk_change(spark, folder):
    change = P.span_change(X.all_orders(spark, folder), ["a"], start=1996, end=2000)
    shown = SM.rounded(
        change.select(R.ENTITY, "a_start", "a_latest", "a_span_change"),
        {"a_start": 2, "a_latest": 2, "a_span_change": 2},
        half_even=False,
    )
    return tidy(SM.top_k(shown, "a_span_change", 10, [R.ENTITY], nulls_first=True))


def _topk_latest(metric):
    return with_(PANEL) + f"""select entity, name, {r(metric)} as {metric} from panel
where period = (select max(period) from panel) and grp in {GROUP_LIST} order by {metric} desc nulls last, entity limit 10"""


@add("topk_metric_a", _topk_latest("a"))
def topk_metric_a(spark, folder):
    panel = stored_panel(spark, folder, *R.KEY, R.NAME, "a", R.GROUP)
    latest = C.keep_groups(P.latest_snapshot(panel), R.GROUP, GROUPS)
    return tidy(SM.top_k(latest.select(R.ENTITY, R.NAME, "a"), "a", 10, [R.ENTITY]))


@add("topk_metric_b", _topk_latest("b"))
def topk_metric_b(spark, folder):
    panel = stored_panel(spark, folder, *R.KEY, R.NAME, "b", R.GROUP)
    latest = C.keep_groups(P.latest_snapshot(panel), R.GROUP, GROUPS)
    return tidy(SM.top_k(latest.select(R.ENTITY, R.NAME, "b"), "b", 10, [R.ENTITY]))


@add(
    "topk_span_change",
    with_(PANEL, SPAN_SLICES.format(source="panel"))
    + f"""select e.entity, e.name, {r('e.b - s.b')} as b_span_change from end_rows e join start_rows s on e.entity = s.entity
where e.grp in {GROUP_LIST} order by e.b - s.b desc nulls last, e.entity limit 10""",
)
def topk_span_change(spark, folder):
    change = P.span_change(stored_panel(spark, folder, *R.KEY, R.NAME, "b", R.GROUP), ["b"], [R.NAME, R.GROUP])
    kept = C.keep_groups(change, R.GROUP, GROUPS).select(R.ENTITY, R.NAME, "b_span_change")
    return tidy(SM.top_k(kept, "b_span_change", 10, [R.ENTITY]))


@add(
    "entity_series",
    with_(PANEL)
    + f"""select period, {shown('a', 2)} as a, b from panel where entity = (select min(o_custkey) from orders) order by period""",
)
def entity_series(spark, folder):
    """The entity filter is pushed through both aggregations down to the scans."""
    first = X.table(spark, folder, "orders").agg(F.min("o_custkey")).scalar()
    series = P.entity_series(X.panel(spark, folder), first, ["a", "b"])
    return tidy(SM.rounded(series, {"a": 2}, half_even=False))


@add("scan_history", with_(PANEL) + f"select entity, name, period, {r('a')} as a, b, {r('b2')} as b2, grp, grp_code from panel order by entity, period")
def scan_history(spark, folder):
    columns = [R.ENTITY, R.NAME, R.PERIOD, "a", "b", "b2", R.GROUP, R.GROUP_CODE]
    return tidy(C.sorted_for_sink(X.panel(spark, folder).select(*columns), R.KEY))


# ---- slices, predicates, profiles over the long fact --------------------------------------


@add(
    "category_slice",
    with_(OBSERVATIONS)
    + f"""select entity, period, {r('a')} as a, {r('a_low')} as a_low, {r('a_high')} as a_high, grp, grp_code
from observations where category = 'All orders'""",
)
def category_slice(spark, folder):
    rows = X.observations(spark, folder)
    return tidy(C.category_slice(rows, R.CATEGORY, "All orders", [R.CATEGORY, R.CATEGORY_CODE]))


@add(
    "filter_point",
    with_(OBSERVATIONS)
    + f"""select entity, category_code, {r('a')} as a from observations where period = 1999 and category = 'Urgent'""",
)
def filter_point(spark, folder):
    rows = C.at_point(X.observations(spark, folder), period=1999, category="Urgent")
    return tidy(rows.select(R.ENTITY, R.CATEGORY_CODE, "a"))


@add(
    "profile_value_counts",
    """select o_orderpriority as value, count(*) as row_count from orders group by 1
union all select cast(null as varchar), count(*) from lineitem left join orders
  on l_orderkey = o_orderkey and year(l_shipdate) = year(o_orderdate) where o_orderkey is null""",
)
def profile_value_counts(spark, folder):
    """Priorities of all orders, and of lines shipped in another year than ordered (no match, NULL)."""
    orders = X.table(spark, folder, "orders")
    lines = X.table(spark, folder, "lineitem").select("l_orderkey", F.year("l_shipdate").alias("ship_year"))
    keyed = orders.select("o_orderkey", F.year("o_orderdate").alias("order_year"))
    unmatched = lines.join(
        keyed, (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("ship_year") == F.col("order_year")), "left_anti"
    )
    mixed = orders.select("o_orderpriority").unionByName(unmatched.select(F.lit(None).cast("string").alias("o_orderpriority")))
    return tidy(Q.value_counts(mixed, "o_orderpriority"))


@add(
    "profile_range",
    with_(OBSERVATIONS)
    + """select count(*) as row_count, min(period) as min_period, max(period) as max_period,
  count(distinct entity) as entities from observations""",
)
def profile_range(spark, folder):
    return tidy(Q.profile_range(X.observations(spark, folder), R.ENTITY, R.PERIOD))


@add(
    "profile_distinct_ends",
    """select value, which_end from (
  select p_name as value, 'head' as which_end from (select distinct p_name from part order by p_name limit 20)
  union all select p_name, 'tail' from (select distinct p_name from part order by p_name desc limit 20))""",
)
def profile_distinct_ends(spark, folder):
    return Q.distinct_ends(X.table(spark, folder, "part"), "p_name", 20)


@add(
    "verify_by_category",
    with_(OBSERVATIONS)
    + """select category, count(*) as row_count, min(period) as min_period, max(period) as max_period
from observations group by category order by category""",
)
def verify_by_category(spark, folder):
    return tidy(Q.verify_by_category(X.observations(spark, folder), R.CATEGORY, R.PERIOD).orderBy(R.CATEGORY))


@add(
    "verify_overall",
    with_(supply_cte())
    + """select count(*) as row_count, min(period) as min_period, max(period) as max_period,
  count(distinct entity) as entities from supply""",
)
def verify_overall(spark, folder):
    return tidy(Q.verify_overall(X.supply(spark, folder), R.ENTITY, R.PERIOD))


# ---- stored forms -------------------------------------------------------------------------


def _exported(spark, folder):
    panel = materialise(P.add_changes(X.panel(spark, folder)), "panel")
    core = RK.add_ranks(panel, {"a_rank": "a", "b_rank": "b"}, [R.PERIOD])
    return {
        "latest": core.where(F.col(R.PERIOD) == P.latest_period(panel)),
        "entity_period": core,
        "group_summary": SM.group_summary(panel),
        "entity_change": P.span_change(panel, ["a", "b"], [R.NAME, R.GROUP, R.GROUP_CODE]),
    }


EXPORT_COUNTS = with_(PANEL, GROUP_SUMMARY, SPAN_SLICES.format(source="panel")) + """
select 'latest' as view_name, count(*) as row_count, sum(a_rank) as checksum
  from (select period, rank() over (partition by period order by a desc nulls first) as a_rank from panel)
  where period = (select max(period) from panel)
union all select 'entity_period', count(*), sum(a_rank)
  from (select rank() over (partition by period order by a desc nulls first) as a_rank from panel)
union all select 'group_summary', count(*), sum(entities) from group_summary
union all select 'entity_change', count(*), sum(e.entity) from end_rows e join start_rows s on e.entity = s.entity"""
EXPORT_COUNTS = f"select view_name, row_count, cast(checksum as bigint) as checksum from ({EXPORT_COUNTS})"
CHECKED = {"latest": "a_rank", "entity_period": "a_rank", "group_summary": "entities", "entity_change": "entity"}


def _counts(frames):
    parts = [
        df.agg(F.count("*").alias("row_count"), F.sum(F.col(CHECKED[name]).cast("bigint")).alias("checksum")).select(
            F.lit(name).alias("view_name"), "row_count", "checksum"
        )
        for name, df in frames.items()
    ]
    return tidy(C.union_all(parts))


@add("export_views", EXPORT_COUNTS)
def export_views(spark, folder):
    """Four views written as CSV from one stored panel; what is read back is counted."""
    out = new_path(spark, "exports")
    views = _exported(spark, folder)
    T.export_views(views, out)
    return _counts({n: T.read(spark, f"{out}/{n}", "csv", df.schema) for n, df in views.items()})


@add("load_with_fallback", EXPORT_COUNTS)
def load_with_fallback(spark, folder):
    """One of the four exports is absent, so all four come from the views."""
    out = new_path(spark, "partial")
    views = _exported(spark, folder)
    T.export_views({"latest": views["latest"], "group_summary": views["group_summary"]}, out, "parquet")
    loaded = T.load_with_fallback(
        spark,
        {n: f"{out}/{n}" for n in views},
        {n: (lambda df=df: df) for n, df in views.items()},
        {"metrics": (f"{out}/metrics", views["group_summary"].schema)},
    )
    empty = loaded.pop("metrics")
    loaded["group_summary"] = loaded["group_summary"].unionByName(empty)
    return _counts(loaded)
