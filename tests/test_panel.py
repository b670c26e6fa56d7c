from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from paneloom import roles as R
from paneloom.functions import aggregates as A
from paneloom.operators import panel as P
from paneloom.operators import ranking as RK
from paneloom.operators import summary as SM
from paneloom.store import materialise

COLUMNS = "entity int, name string, period int, a double, b double, b2 double, grp string, grp_code int"


def gapped_rows(seed, entities=40, periods=8):
    """Gaps, ties, NULL metrics, late starters and early leavers."""
    rng = random.Random(seed)
    rows = []
    for e in range(entities):
        first, last = rng.choice([0, 0, 1]), rng.choice([periods, periods, periods - 1])
        for p in range(first, last):
            if rng.random() < 0.8:
                a = None if rng.random() < 0.1 else float(rng.randint(0, 5))
                b = None if rng.random() < 0.1 else rng.random()
                rows.append((e, f"n{e}", p, a, b, rng.random(), "G%d" % (e % 3), e % 3))
    return rows


@pytest.fixture(params=[1, 2])
def panel(spark, request):
    return materialise(spark.createDataFrame(gapped_rows(request.param), COLUMNS))


def same(left, right):
    right = right.select(*left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_span_change_equals_the_join_of_two_slices(panel):
    single = P.span_change(panel, ["a"]).select("entity", "a_start", "a_latest", "a_span_change")
    assert same(single, P.slice_join(panel, "a", P.first_period(panel), P.latest_period(panel)))
    assert single.count() < panel.select("entity").distinct().count()


def test_category_gap_equals_the_self_join(spark):
    rng = random.Random(3)
    rows = [(e, p, c, rng.random(), "g") for e in range(30) for p in range(3) for c in "FMX" if rng.random() < 0.7]
    df = materialise(spark.createDataFrame(rows, "entity int, period int, category string, a double, grp string"))
    got = P.category_gap(df, "F", "M", "a", ["grp"], P.latest_period(df))
    f, m = df.where("category = 'F' and period = 2"), df.where("category = 'M' and period = 2")
    want = f.alias("f").join(m.alias("m"), ["entity", "period"]).select(
        "entity", "period", F.col("f.a").alias("first_value"), F.col("m.a").alias("second_value"),
        "f.grp", (F.col("f.a") - F.col("m.a")).alias("gap"),
    )
    assert same(got, want)


def test_row_and_calendar_offsets_differ_at_gaps(spark):
    df = spark.createDataFrame([(1, p, float(p)) for p in (1, 2, 4, 5)], "entity int, period int, a double")
    by_row = P.row_offsets(df, {"back": ("a", 1)}).orderBy("period").select("back")
    by_date = P.calendar_offsets(df, {"back": ("a", 1)}).orderBy("period").select("back")
    assert [r.back for r in by_row.collect()] == [None, 1.0, 2.0, 4.0]
    assert [r.back for r in by_date.collect()] == [None, 1.0, None, 4.0]


@pytest.mark.parametrize("by", [[], ["period"]])
def test_value_rank_equals_rank(panel, by):
    ranks = {"ra": "a", "rb": "b"}
    plain = panel.withColumns(
        {o: F.rank().over(Window.partitionBy(*by).orderBy(F.desc_nulls_first(m))) for o, m in ranks.items()}
    )
    assert same(RK.add_ranks(panel, ranks, by), plain)


def test_rank_with_one_value_holding_most_rows(spark):
    rows = [(i, 7.0 if i % 3 else float(i)) for i in range(900)] + [(i, None) for i in range(900, 1000)]
    df = materialise(spark.createDataFrame(rows, "entity int, a double"))
    plain = df.withColumn("r", F.rank().over(Window.orderBy(F.desc_nulls_first("a"))))
    assert same(RK.add_ranks(df, {"r": "a"}), plain)


def test_rank_of_nothing_but_nulls_and_null_groups(spark):
    rows = [(i, None if i % 2 else 1, None) for i in range(50)]
    df = materialise(spark.createDataFrame(rows, "entity int, period int, a double"))
    out = RK.add_ranks(df, {"r": "a"}, ["period"])
    assert out.count() == 50 and {r.r for r in out.collect()} == {1}


def test_rank_with_one_group_holding_a_third(spark):
    """One group holds a third of all rows, the others a few each."""
    rows = [(i, 0 if i % 3 == 0 else i // 6, float(i % 17) if i % 5 else None) for i in range(1200)]
    df = materialise(spark.createDataFrame(rows, "entity int, period int, a double"))
    plain = df.withColumn("r", F.rank().over(Window.partitionBy("period").orderBy(F.desc_nulls_first("a"))))
    assert same(RK.add_ranks(df, {"r": "a"}, ["period"]), plain)


@pytest.mark.parametrize(
    "value",
    ["cast(9007199254740992 + id % 40 as bigint)", "cast(concat('123456789012345678901', id % 40) as decimal(38,0))", "cast(id % 7 as tinyint)",
     "cast(id % 9 as decimal(18,8)) / 7", "cast(if(id % 4 = 0, 'NaN', if(id % 4 = 1, '-0.0', '0.0')) as float)", "cast(id % 5 as string)", "timestamp_seconds(id % 11)"],
)
def test_rank_of_any_type(spark, value):
    df = materialise(spark.range(600).selectExpr("id", "id % 3 as period", f"if(id % 13 = 0, null, {value}) as a"))
    plain = df.withColumn("r", F.rank().over(Window.partitionBy("period").orderBy(F.desc_nulls_first("a"))))
    ranked = RK.add_ranks(df, {"r": "a"}, ["period"])
    assert dict(ranked.dtypes)["r"] == "bigint"
    assert sorted((x.id, x.r) for x in ranked.collect()) == sorted((x.id, x.r) for x in plain.collect())


def test_nulls_rank_first(spark):
    df = materialise(spark.createDataFrame([(1, 5.0), (2, None), (3, 9.0)], "entity int, a double"))
    assert {r.entity: r.r for r in RK.add_ranks(df, {"r": "a"}).collect()} == {2: 1, 3: 2, 1: 3}


def test_correlation_of_degenerate_groups_is_null(spark):
    rows = [("one", 1.0, 2.0), ("flat", 1.0, 2.0), ("flat", 1.0, 3.0), ("line", 1.0, 2.0), ("line", 2.0, 4.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    out = df.groupBy("g").agg(
        A.correlation(F.col("y"), F.col("x")).alias("c"), A.ols_slope(F.col("y"), F.col("x")).alias("s")
    )
    assert {r.g: (r.c, r.s) for r in out.collect()} == {"one": (None, None), "flat": (None, None), "line": (1.0, 2.0)}


def test_trendline_ignores_incomplete_pairs(spark):
    rows = [("g", 1.0, 3.0), ("g", 2.0, 5.0), ("g", None, 9.0), ("g", 4.0, None)]
    row = SM.trendline(spark.createDataFrame(rows, "g string, b double, a double"), ["g"], "a", "b").first()
    assert (row.n, row.slope, row.intercept, row.r2) == (2, 2.0, 1.0, 1.0)


def test_latest_depends_on_what_it_is_latest_within(spark):
    df = spark.createDataFrame([(1, 2000), (2, 2001)], "entity int, period int")
    other = spark.createDataFrame([(9, 2000)], "entity int, period int")
    assert [r.entity for r in P.latest_snapshot(df).collect()] == [2]
    assert [r.entity for r in P.latest_snapshot(df, other).collect()] == [1]


def test_top_k_null_placement(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, 5.0), (4, 1.0)], "entity int, a double")
    assert [r.entity for r in SM.top_k(df, "a", 2, ["entity"], nulls_first=True).collect()] == [1, 2]
    assert [r.entity for r in SM.top_k(df, "a", 2, ["entity"]).collect()] == [2, 3]


def test_group_summary_counts_rows_when_keys_are_unique(panel):
    panel = panel.withColumns({R.METRIC_A_LOW: F.col("a"), R.METRIC_A_HIGH: F.col("a")})
    assert same(
        SM.group_summary(panel).select("grp", "period", "entities"),
        SM.group_summary(panel, keys_are_unique=True).select("grp", "period", "entities"),
    )


def test_spec_renames_both_ways(spark):
    spec = R.PanelSpec(entity="iso3", period="year", a="pct")
    df = spark.createDataFrame([("DEU", 2020, 1.0)], "iso3 string, year int, pct double")
    assert spec.to_roles(df).columns == ["entity", "period", "a"]
    assert spec.from_roles(spec.to_roles(df)).columns == ["iso3", "year", "pct"]
