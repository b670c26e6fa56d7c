from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneloom.functions import scalars as S
from paneloom.operators import clean as C
from paneloom.operators import quality as Q


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_numbers_from_text(spark):
    texts = ["1", " 2.5 ", "2010.0", "-3e2", ".5", "n/a", "", "1d", "0x10", None]
    df = spark.createDataFrame([(t,) for t in texts], "v string").withColumn("n", S.text_to_number(F.col("v")))
    assert [r.n for r in df.collect()] == [1.0, 2.5, 2010.0, -300.0, 0.5, None, None, None, None, None]


def test_period_written_as_float(spark):
    df = spark.createDataFrame([("2010.0",), ("x",)], "year string")
    out = C.periods_to_int(C.coerce_numeric(df, ["year"]), "year")
    assert dict(out.dtypes)["year"] == "int"
    assert [r.year for r in out.collect()] == [2010, None]


def test_alpha3_matches_whole_value_only(spark):
    codes = ["DEU", "GLOBAL", "deu", "DE", "DEU\n", "D3U", None]
    df = spark.createDataFrame([(c,) for c in codes], "code string")
    assert [r.code for r in C.keep_alpha3(df, "code").collect()] == ["DEU"]


def test_missing_key_stays_missing(spark):
    df = C.normalise_keys(spark.createDataFrame([(" deu ",), (None,)], "code string"), ["code"])
    assert [r.code for r in df.collect()] == ["DEU", None]
    assert C.drop_missing(df, ["code"]).count() == 1


def test_drop_missing_takes_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert C.drop_missing(df, ["x"]).count() == 1


@pytest.mark.parametrize(
    "raw, clean", [("'276", "276"), ("4.0", "004"), (" 8 ", "008"), ("1234", "1234"), ("'004.0'", "004"), (None, None)]
)
def test_numeric_codes(spark, raw, clean):
    df = spark.createDataFrame([(raw,)], "c string").select(S.canonical_numeric_code(F.col("c")).alias("c"))
    assert df.first().c == clean


def test_unknown_code_is_kept_as_null(spark):
    df = spark.createDataFrame([("'276",), ("999",)], "code string")
    dim = spark.createDataFrame([(276, "DEU")], "number int, iso3 string")
    out = C.lookup_codes(df, "code", dim, "number", "iso3", "iso3")
    assert values(out, "code", "iso3") == [("'276", "DEU"), ("999", None)]


def test_keep_first_follows_the_order_column(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (2, 9, "z"), (1, 2, "b")], "k int, pos int, v string")
    assert values(C.keep_first(df, ["k"], ["pos"]), "k", "v") == [(1, "a"), (2, "z")]


def test_pivot_takes_first_non_null(spark):
    rows = [("A", "kg", None, 1), ("A", "kg", 5.0, 2), ("A", "kg", 7.0, 3), ("A", "kcal", 9.0, 4), ("B", "kcal", None, 5)]
    df = spark.createDataFrame(rows, "k string, e string, v double, pos int")
    out = C.pivot_first(df, ["k"], "e", "v", F.col("pos"), {"kg": "kg", "kcal": "kcal", "t": "t"})
    assert values(out, "k", "kg", "kcal", "t") == [("A", 5.0, 9.0, None)]


def test_item_filter_is_literal_and_element_filter_exact(spark):
    rows = [("Sugar & Sweeteners, x", "kg"), ("sugar & sweeteners", "kg "), ("Sugar . Sweeteners", "kg"), (None, "kg")]
    df = spark.createDataFrame(rows, "item string, element string")
    kept = C.keep_items(df, "item", "sugar & sweeteners", "element", ["kg"])
    assert values(kept, "item") == [("Sugar & Sweeteners, x",)]


def test_ensure_columns_adds_and_orders(spark):
    schema = T.StructType().add("b", T.DoubleType()).add("a", T.IntegerType())
    out = C.ensure_columns(spark.createDataFrame([(1,)], "a int"), schema)
    assert out.columns == ["b", "a"] and tuple(out.first()) == (None, 1)


def test_recode_passes_unknown_codes(spark):
    df = spark.createDataFrame([("F",), ("X",), (None,)], "c string")
    out = C.recode_passthrough(df, "c", "label", {"F": "Female"})
    assert [r.label for r in out.collect()] == ["Female", "X", None]


def test_rounding_modes(spark):
    row = spark.range(1).select(S.round_half_up(F.lit(2.5), 0).alias("up"), S.round_half_even(F.lit(2.5), 0).alias("even")).first()
    assert (row.up, row.even) == (3.0, 2.0)


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (50.0,), (500.0,)], "x double")
    assert [r[0] for r in df.select(S.clip(F.col("x"), 0, 100)).collect()] == [None, 0.0, 50.0, 100.0]


def test_ramp_is_flat_when_the_end_is_past(spark):
    df = spark.createDataFrame([(10.0, 2020, 2030), (10.0, 2030, 2030), (10.0, 2031, 2030)], "v double, l int, e int")
    out = df.select(S.ramp(F.col("v"), F.lit(0.5), F.lit(2025), F.col("l"), F.col("e")).alias("r"))
    assert [r.r for r in out.collect()] == [12.5, 10.0, 10.0]


def test_contract_names_what_is_missing(spark):
    with pytest.raises(Q.ContractError, match="'b', 'c'"):
        Q.require_columns(spark.range(1).toDF("a"), ["a", "b", "c"])


def test_key_violations(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, None), (3, "z")], "k int, v string")
    assert values(Q.key_violations(df, ["k"], ["k", "v"]), "k", "row_count", "null_count") == [(1, 2, 0), (2, 1, 1)]
    with pytest.raises(Q.ContractError):
        Q.require_unique_key(df, ["k"])


def test_value_counts_have_a_null_group(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",)], "c string")
    assert values(Q.value_counts(df, "c"), "value", "row_count") == [("a", 2), (None, 1)]


def test_accounting(spark):
    df = spark.createDataFrame([("DEU", 1), ("GLOBAL", 2), ("FRA", 5), (None, 9)], "code string, year int")
    row = Q.load_accounting(df, S.is_alpha3(F.col("code")), "code", "year").first()
    assert (row.rows_before, row.rows_after, row.rows_removed, row.entities, row.min_period, row.max_period) == (4, 2, 2, 2, 1, 5)
