"""Raw feeds through to the views, on a few countries."""

from __future__ import annotations

import json

import pytest

from paneloom.plans import ingest
from paneloom.plans.views import SPEC, Views
from paneloom.sources import landed, tables
from paneloom.sources import schemas as X
from paneloom.store import new_path

YEARS = range(2010, 2020)
COUNTRIES = {"DEU": ("276", "Germany", "Europe", 20.0), "FRA": ("250", "France", "Europe", 18.0), "IND": ("356", "India", "South-East Asia", 4.0)}


def prevalence_page():
    rows = []
    for iso3, (_, _, region, level) in COUNTRIES.items():
        for year in YEARS:
            for code, shift in (("SEX_BTSX", 0.0), ("SEX_MLE", -1.0), ("SEX_FMLE", 2.0)):
                value = level + shift + 0.1 * (year - 2010)
                rows.append({"SpatialDim": f" {iso3.lower()} ", "TimeDim": year, "Dim1": code, "NumericValue": value,
                             "Low": value - 1, "High": value + 1, "ParentLocation": region, "ParentLocationCode": region[:3]})
    rows.append(dict(rows[0], NumericValue=99.0))  # a repeat of the first key: the first stays
    rows.append(dict(rows[0], SpatialDim="GLOBAL"))
    rows.append(dict(rows[0], SpatialDim="XXX", NumericValue=None))
    return {"value": rows}


def supply_csv():
    lines = ["Area Code,Area Code (M49),Area,Item,Element,Year,Unit,Value,Note"]
    for iso3, (m49, name, _, level) in COUNTRIES.items():
        for year in YEARS:
            for element, factor in (("Food supply quantity (kg/capita/yr)", 2.0), ("Food supply (kcal/capita/day)", 15.0)):
                lines.append(f"9,'{m49},{name},Sugar & Sweeteners,{element},{year},u,{level * factor - (year - 2010)},")
    lines.append("9,'276,Germany,Sugar & Sweeteners,Food supply (kcal/capita/day),2010,u,1.0,repeat")
    lines.append("9,'999,Nowhere,Sugar & Sweeteners,Food supply (kcal/capita/day),2010,u,1.0,")
    lines.append("9,'276,Germany,Wheat,Food supply (kcal/capita/day),2010,u,1.0,")
    lines.append("9,'276,Germany,Sugar & Sweeteners,Protein,2010,u,1.0,")
    return "\n".join(lines) + "\n"


@pytest.fixture(scope="module")
def views(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("feeds")
    (folder / "p").mkdir()
    (folder / "s").mkdir()
    (folder / "p" / "1.json").write_text(json.dumps(prevalence_page()))
    (folder / "s" / "bulk.csv").write_text(supply_csv())
    raw = landed.read_json_pages(spark, str(folder / "p"), X.PREVALENCE_FEED, ordinal=True)
    who = ingest.loadable_prevalence(ingest.clean_prevalence(raw))
    codes = spark.createDataFrame([(int(m49), iso3) for iso3, (m49, *_) in COUNTRIES.items()], "code int, iso3 string")
    long = landed.read_long_csv(spark, str(folder / "s"), X.SUPPLY_ALIASES, ordinal=True)
    fao = ingest.loadable_supply(ingest.require_supply(ingest.clean_supply(long, codes)))
    root = new_path(spark, "tables")
    assert tables.full_refresh(who, "who_loaded", root, ["iso3", "year", "sex_code"]) == 3 * 10 * 3
    assert tables.full_refresh(fao, "fao_loaded", root, ["iso3", "year"]) == 3 * 10
    return Views(spark.table("who_loaded"), spark.table("fao_loaded"))


def test_base_tables(spark, views):
    who = spark.table("who_loaded")
    assert who.dtypes == [(f.name, f.dataType.simpleString()) for f in X.WHO_OBESITY.fields]
    first = who.where("iso3 = 'DEU' and year = 2010 and sex = 'Both sexes'").first()
    assert first.obesity_pct == 20.0
    fao = spark.table("fao_loaded").where("iso3 = 'DEU' and year = 2010").first()
    assert (fao.country, fao.sugar_supply_kg_per_capita, fao.sugar_supply_kcal_per_capita_day) == ("Germany", 40.0, 300.0)


def test_registered_views_answer_sql(spark, views):
    assert len(views.register()) == 13
    row = spark.sql("select * from v_sugar_obesity_latest where iso3 = 'FRA'").first()
    assert (row.year, row.obesity_rank_in_year, row.sugar_rank_in_year) == (2019, 2, 2)
    assert row.obesity_change_from_previous_year == pytest.approx(0.1)
    assert row.sugar_change_from_previous_year == pytest.approx(-1.0)
    change = spark.sql("select * from v_sugar_obesity_country_change where iso3 = 'IND'").first()
    assert (change.start_year, change.end_year) == (2010, 2019)
    assert change.obesity_change_pct_points == pytest.approx(0.9)
    assert change.sugar_change_kg_per_capita == pytest.approx(-9.0)
    gap = spark.sql("select * from v_obesity_sex_gap_latest where iso3 = 'DEU'").first()
    assert gap.female_minus_male_gap == pytest.approx(3.0)
    region = spark.sql("select * from v_sugar_obesity_region_summary where year = 2019 order by who_region").collect()
    assert [(r.countries, r.sugar_obesity_corr) for r in region] == [(2, pytest.approx(1.0)), (1, None)]
    latest = spark.sql("select * from v_obesity_latest_country order by obesity_rank").collect()
    assert [r.iso3 for r in latest] == ["DEU", "FRA", "IND"]
    assert spark.sql("select count(*) from v_obesity_region_summary_latest").first()[0] == 2
    assert spark.sql("select count(*) from v_obesity_country_change where increase_rank <= 3").first()[0] == 3


def test_feature_views(spark, views):
    level = views.ml_obesity_features().where("iso3 = 'DEU' and year = 2013").first()
    assert (level.obesity_lag_3, level.target_obesity_next_year) == (20.0, pytest.approx(20.4))
    change = views.ml_sugar_sensitivity_features().where("iso3 = 'DEU' and year = 2013").first()
    assert change.target_obesity_change_3yr == pytest.approx(0.3)
    assert change.sugar_change_3yr == pytest.approx(-3.0)


# The columns users of the views rely on.
EXPECTED_COLUMNS = {
    "sugar_obesity_country_year": [
        "iso3", "country", "year", "obesity_pct", "obesity_pct_low", "obesity_pct_high", "sugar_supply_kg_per_capita",
        "sugar_supply_kcal_per_capita_day", "who_region", "who_region_code", "obesity_rank_in_year",
        "sugar_rank_in_year", "obesity_change_from_previous_year", "sugar_change_from_previous_year",
    ],
    "sugar_obesity_region_summary": [
        "who_region", "year", "countries", "avg_obesity_pct", "avg_sugar_kg_per_capita",
        "avg_sugar_kcal_per_capita_day", "sugar_obesity_corr",
    ],
    "obesity_country_year": [
        "iso3", "year", "obesity_pct", "obesity_pct_low", "obesity_pct_high", "who_region", "who_region_code",
    ],
}


@pytest.mark.parametrize("name", EXPECTED_COLUMNS)
def test_view_columns(views, name):
    assert getattr(views, name)().columns == EXPECTED_COLUMNS[name]


def test_exports(spark, views):
    folder = new_path(spark, "dashboard")
    written = tables.export_views(views.exports(), folder)
    assert written == {"dashboard_latest": 3, "dashboard_country_year": 30, "dashboard_region_summary": 20, "dashboard_country_change": 3}
    back = tables.read(spark, f"{folder}/dashboard_latest", "csv", views.sugar_obesity_latest().schema)
    assert {r.iso3 for r in SPEC.to_roles(back).select("entity").withColumnRenamed("entity", "iso3").collect()} == set(COUNTRIES)
