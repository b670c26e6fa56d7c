"""From landed feeds to the two base tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneloom.operators import clean as C
from paneloom.operators.quality import require_columns, require_rows
from paneloom.sources import schemas as X
from paneloom.sources.landed import ORDINAL


def clean_prevalence(raw: DataFrame) -> DataFrame:
    """Prevalence feed -> one row per (iso3, year, sex_code); ``raw`` carries file positions."""
    require_columns(raw, [*X.PREVALENCE_NAMES, ORDINAL])
    rows = C.project_rename(raw, {**X.PREVALENCE_NAMES, ORDINAL: ORDINAL})
    rows = C.recode_passthrough(rows, "sex_code", "sex", X.SEX_LABELS)
    rows = C.coerce_numeric(rows, ["year", "obesity_pct", "obesity_pct_low", "obesity_pct_high"])
    rows = C.periods_to_int(C.normalise_keys(rows, ["iso3"]), "year")
    rows = C.drop_missing(rows, ["iso3", "year", "obesity_pct"])
    first = C.keep_first(rows, ["iso3", "year", "sex_code"], [ORDINAL])
    return first.select(*X.WHO_OBESITY.names)


def clean_supply(long: DataFrame, country_codes: DataFrame) -> DataFrame:
    """Long supply table -> one row per (iso3, country, year).

    ``country_codes`` is the dimension (code, iso3). The cheap row filters come first, so the
    lookup and the pivot see only the wanted item.
    """
    kept = C.keep_items(long, "item", X.SUPPLY_ITEM, "element", list(X.SUPPLY_ELEMENTS))
    kept = C.lookup_codes(kept, "area_code_m49", country_codes, "code", "iso3", "iso3")
    kept = C.periods_to_int(C.coerce_numeric(kept, ["year", "value"]), "year")
    kept = C.drop_missing(kept, ["iso3", "year", "value"])
    wide = C.pivot_first(kept, ["iso3", "country", "year"], "element", "value", F.col(ORDINAL), X.SUPPLY_ELEMENTS)
    return C.ensure_columns(wide, X.FAOSTAT_SUGAR_SUPPLY)


def loadable_prevalence(cleaned: DataFrame) -> DataFrame:
    """Country rows only: aggregates such as world or region codes do not match three letters."""
    rows = C.keep_alpha3(C.normalise_keys(cleaned, ["iso3"]), "iso3")
    return require_columns(rows, X.WHO_OBESITY.names).select(*X.WHO_OBESITY.names)


def loadable_supply(cleaned: DataFrame) -> DataFrame:
    require_columns(cleaned, X.FAOSTAT_SUGAR_SUPPLY.names)
    rows = C.keep_alpha3(C.normalise_keys(cleaned, ["iso3"]), "iso3")
    rows = C.coerce_numeric(rows, ["year", *X.SUPPLY_ELEMENTS.values()])
    rows = C.periods_to_int(C.drop_missing(rows, ["iso3", "country", "year"]), "year")
    return rows.select(*X.FAOSTAT_SUGAR_SUPPLY.names)


def require_supply(cleaned: DataFrame) -> DataFrame:
    return require_rows(cleaned, f"no {X.SUPPLY_ITEM} rows found in the supply table")
