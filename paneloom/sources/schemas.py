"""Declared schemas of the raw feeds and the two base tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _I = T.StringType(), T.DoubleType(), T.IntegerType()


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# Field names, codes and item/element texts of the two public feeds.
PREVALENCE_FEED = _struct(
    ("SpatialDim", _S, True),
    ("TimeDim", _S, True),
    ("Dim1", _S, True),
    ("NumericValue", _S, True),
    ("Low", _S, True),
    ("High", _S, True),
    ("ParentLocation", _S, True),
    ("ParentLocationCode", _S, True),
)
PREVALENCE_NAMES = {
    "SpatialDim": "iso3",
    "TimeDim": "year",
    "Dim1": "sex_code",
    "NumericValue": "obesity_pct",
    "Low": "obesity_pct_low",
    "High": "obesity_pct_high",
    "ParentLocation": "who_region",
    "ParentLocationCode": "who_region_code",
}
SEX_LABELS = {"SEX_BTSX": "Both sexes", "SEX_MLE": "Male", "SEX_FMLE": "Female"}
SUPPLY_ALIASES = {
    "area_code_m49": ["Area Code (M49)", "Area Code"],
    "country": ["Area"],
    "item": ["Item"],
    "element": ["Element"],
    "year": ["Year"],
    "unit": ["Unit"],
    "value": ["Value"],
}
SUPPLY_ITEM = "Sugar & Sweeteners"
SUPPLY_ELEMENTS = {
    "Food supply quantity (kg/capita/yr)": "sugar_supply_kg_per_capita",
    "Food supply (kcal/capita/day)": "sugar_supply_kcal_per_capita_day",
}
CATALOGUE_PHRASES = ["Food Balances", "Food Balance Sheets"]
CATALOGUE_PREFERRED = r"Food Balances \(2010-\)"
CATALOGUE_LOCATION = "FileLocation"

WHO_OBESITY = _struct(
    ("iso3", _S, False),
    ("year", _I, False),
    ("sex", _S, False),
    ("sex_code", _S, False),
    ("obesity_pct", _D, True),
    ("obesity_pct_low", _D, True),
    ("obesity_pct_high", _D, True),
    ("who_region", _S, True),
    ("who_region_code", _S, True),
)
FAOSTAT_SUGAR_SUPPLY = _struct(
    ("iso3", _S, False),
    ("country", _S, False),
    ("year", _I, False),
    ("sugar_supply_kg_per_capita", _D, True),
    ("sugar_supply_kcal_per_capita_day", _D, True),
)
