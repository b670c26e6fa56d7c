from __future__ import annotations

import json
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneloom.operators.quality import ContractError
from paneloom.sources import landed, tables
from paneloom.store import new_path, shared_dir

ROW = T.StructType().add("code", T.StringType()).add("year", T.StringType())
TABLE = T.StructType().add("iso3", T.StringType()).add("year", T.IntegerType()).add("pct", T.DoubleType())


def write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


def test_pages_of_a_feed(spark, tmp_path):
    first = {"value": [{"code": "DEU", "year": 2020}, {"code": "FRA", "year": 2021}], "@odata.nextLink": "page/2"}
    second = {"value": [{"code": "ITA", "year": 2020, "extra": 1}]}
    write(tmp_path / "files", "1.json", json.dumps(first, indent=2))
    path = write(tmp_path / "files", "2.json", json.dumps(second, indent=2))
    whole = landed.read_json_pages(spark, path, ROW, whole_files=True)
    assert sorted(r.code for r in whole.collect()) == ["DEU", "FRA", "ITA"]
    lines = write(tmp_path / "lines", "all.json", json.dumps(first) + "\n" + json.dumps(second))
    placed = landed.read_json_pages(spark, lines, ROW, ordinal=True)
    assert [r.code for r in placed.orderBy(landed.ORDINAL).collect()] == ["DEU", "FRA", "ITA"]


def test_page_without_value_fails(spark, tmp_path):
    path = write(tmp_path, "1.json", json.dumps({"error": "busy"}))
    with pytest.raises(Exception, match="without a 'value' array"):
        landed.read_json_pages(spark, path, ROW).collect()


def test_xml_catalogue_with_namespace(spark, tmp_path):
    xml = """<c:Datasets xmlns:c="urn:x"><Dataset><c:DatasetCode>FBS</c:DatasetCode><c:FileRows>12</c:FileRows></Dataset>
    <Dataset><c:DatasetCode>QCL</c:DatasetCode></Dataset></c:Datasets>"""
    path = write(tmp_path, "c.xml", xml)
    rows = landed.read_xml_catalogue(spark, path, "Dataset", ["DatasetCode", "FileRows"])
    assert sorted(tuple(r) for r in rows.collect()) == [("FBS", "12"), ("QCL", None)]
    assert set(landed.read_xml_catalogue(spark, path, "Dataset").dtypes) == {("DatasetCode", "string"), ("FileRows", "string")}


CATALOGUE = [
    (1, "OLD", "Food Balances (-2013, old)", "u1"),
    (2, "FBS", "food balances (2010-)", "u2"),
    (3, "QCL", None, "u3"),
    (4, "FBS2", "Food Balances (2010-) again", "u4"),
]


def pick(spark, rows, **options):
    df = spark.createDataFrame(rows, "n int, code string, name string, FileLocation string")
    return landed.pick_dataset(df, ["Food Balances", "Food Balance Sheets"], r"Food Balances \(2010-\)", "n", **options)


def test_catalogue_prefers_the_pattern_then_the_first(spark):
    assert pick(spark, CATALOGUE).first().n == 2
    assert pick(spark, CATALOGUE[:1] + CATALOGUE[2:3]).first().n == 1


def test_catalogue_errors(spark):
    with pytest.raises(ContractError, match="no catalogue row"):
        landed.dataset_location(pick(spark, CATALOGUE[2:3]), "FileLocation")
    with pytest.raises(Exception, match="has no FileLocation"):
        pick(spark, [(1, "FBS", "Food Balances (2010-)", None)], location="FileLocation").collect()
    with pytest.raises(ContractError, match="missing required columns"):
        landed.pick_dataset(spark.range(1), ["x"], "x", "id", "FileLocation")


def test_aliases(spark):
    names = {"code": ["Area Code (M49)", "Area Code"], "item": ["Item"]}
    assert landed.resolve_aliases([" area code ", "ITEM", "x"], names) == {"code": " area code ", "item": "ITEM"}
    both = landed.resolve_aliases(["Area Code", "Area Code (M49)", "Item"], names)
    assert both["code"] == "Area Code (M49)"
    with pytest.raises(ContractError, match="Item"):
        landed.resolve_aliases(["Area Code"], names)


def test_csv_contract(spark, tmp_path):
    path = write(tmp_path / "a", "a.csv", "pct,extra,iso3,year\n1.5,x,DEU,2020\nn/a,y,,2021.0\n")
    rows = landed.read_csv_table(spark, path, TABLE).collect()
    assert [tuple(r) for r in rows] == [("DEU", 2020, 1.5), (None, 2021, None)]
    bad = write(tmp_path / "b", "b.csv", "iso3,year\nDEU,2020\n")
    with pytest.raises(ContractError, match="pct"):
        landed.read_csv_table(spark, bad, TABLE)
    with pytest.raises(FileNotFoundError):
        landed.read_csv_table(spark, str(tmp_path / "absent"), TABLE)


def test_csv_ordinal_is_the_file_order(spark, tmp_path):
    lines = "\n".join(f"{i},{i % 3}" for i in range(500))
    path = write(tmp_path, "a.csv", "Area,Item\n" + lines + "\n")
    df = landed.read_long_csv(spark, path, {"area": ["Area"], "item": ["Item"]}, ordinal=True).repartition(4)
    assert [int(r.area) for r in df.orderBy(landed.ORDINAL).collect()] == list(range(500))


def test_landed_csv_keeps_nulls(spark, tmp_path):
    df = spark.createDataFrame([("DEU", 2020, None), ("FRA", None, 2.5)], TABLE)
    path = tables.land(df, str(tmp_path / "out"))
    tables.land(df, path)
    assert sorted(tuple(r) for r in landed.read_csv_table(spark, path, TABLE).collect()) == [("DEU", 2020, None), ("FRA", None, 2.5)]


def test_refresh_replaces_as_a_whole_and_a_failed_one_changes_nothing(spark, tmp_path):
    root, name = str(tmp_path), "refreshed"
    frame = lambda rows: spark.createDataFrame(rows, "k int, v string")
    assert tables.full_refresh(frame([(1, "a"), (2, "b")]), name, root, key=["k"]) == 2
    assert tables.full_refresh(frame([(3, "c")]), name, root, key=["k"]) == 1
    assert [tuple(r) for r in spark.table(name).collect()] == [(3, "c")]
    with pytest.raises(ContractError, match="violated"):
        tables.full_refresh(frame([(4, "d"), (4, "e")]), name, root, key=["k"])
    broken = frame([(5, "e")]).withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        tables.full_refresh(broken, name, root)
    assert [tuple(r) for r in spark.table(name).collect()] == [(3, "c")]


def test_a_scan_outlives_a_reload_until_its_generation_is_swept(spark, tmp_path):
    name, root = f"t_{uuid.uuid4().hex}", str(tmp_path / "it's a root")
    frame = lambda *values: spark.createDataFrame([(v,) for v in values], "v int")
    tables.full_refresh(frame(1, 2), name, root)
    begun = spark.table(name)
    for load in (frame(3), frame(4, 5)):
        tables.full_refresh(load, name, root)
    assert sorted(r.v for r in begun.collect()) == [1, 2]
    assert sorted(r.v for r in spark.table(name).collect()) == [4, 5]
    found = tables.generations(spark, name)
    assert len(found) == 3 and sum(at is None for at in found.values()) == 1
    assert tables.sweep(spark, name) == [] and len(begun.collect()) == 2  # too young
    swept = tables.sweep(spark, name, older_than=0)
    assert len(swept) == 2 and set(found) - set(swept) == set(tables.generations(spark, name))
    assert sorted(r.v for r in spark.table(name).collect()) == [4, 5]
    assert len(list((tmp_path / "it's a root").iterdir())) == 1
    with pytest.raises(ContractError):
        tables.full_refresh(frame(6, 6), name, root, key=["v"])
    assert len(tables.generations(spark, name)) == 1 and spark.table(name).count() == 2
    tables._write_manifest(spark, name, tables._manifest(spark, name) | {str(tmp_path / "it's a root" / "begun"): 1.0})  # a load that died
    assert len(tables.sweep(spark, name)) == 1


def test_a_table_without_a_root_is_not_scratch(spark):
    name = f"t_{uuid.uuid4().hex}"
    tables.full_refresh(spark.range(50), name)
    assert tables.full_refresh(spark.range(60), name) == 60
    folders = list(tables.generations(spark, name))
    assert len(folders) == 2 and all(shared_dir(spark) not in f for f in folders)
    assert all(f.startswith(tables._qualified(spark, spark.conf.get("spark.sql.warehouse.dir"))) for f in folders)
    assert spark.table(name).count() == 60
    tables.sweep(spark, name, older_than=0)
    spark.sql(f"drop table {name}")


def test_facts_bucketed_by_entity_join_and_lag_without_a_shuffle(spark, tmp_path):
    from paneloom.operators import panel as P

    for name, metric in (("bucketed_a", "a"), ("bucketed_b", "b")):
        df = spark.range(3000).select(
            (F.col("id") % 300).alias("entity"), F.floor(F.col("id") / 300).alias("period"), F.rand(1).alias(metric)
        )
        for _ in range(2):  # the second load goes through the swap
            assert tables.full_refresh(df, name, str(tmp_path), ["entity", "period"], 8, ["entity"]) == 3000
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        panel = P.add_changes(P.panel_join(spark.table("bucketed_a"), spark.table("bucketed_b")))
        plan = panel._jdf.queryExecution().executedPlan().toString()
        assert panel.count() == 3000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Window" in plan and "Exchange" not in plan


def test_fallback_needs_every_export(spark):
    folder = new_path(spark, "exports")
    frames = {n: spark.createDataFrame([(n,)], "source string") for n in ("one", "two")}
    views = {n: (lambda n=n: spark.createDataFrame([(f"view {n}",)], "source string")) for n in frames}
    paths = {n: f"{folder}/{n}" for n in frames}
    optional = {"extra": (f"{folder}/extra", T.StructType().add("x", T.IntegerType()))}
    load = lambda: tables.load_with_fallback(spark, paths, views, optional)
    tables.export_views({"one": frames["one"]}, folder, "parquet")
    assert load()["one"].first().source == "view one"
    assert load()["extra"].columns == ["x"] and load()["extra"].isEmpty()
    assert tables.export_views(frames, folder, "parquet") == {"one": 1, "two": 1}
    assert load()["one"].first().source == "one"


@pytest.mark.parametrize("first, second", [(8, 4), (8, None), (None, 8)])
def test_a_reload_keeps_the_buckets(spark, first, second):
    rows = spark.range(1000).withColumn("v", F.col("id") * 2)
    name, other = (f"t_{uuid.uuid4().hex}" for _ in range(2))
    spec = lambda n: {"buckets": n, "bucket_by": ["id"]} if n else {}
    tables.full_refresh(rows, name, **spec(first))
    tables.full_refresh(rows, other, **spec(8))
    if second:
        with pytest.raises(ContractError):
            tables.full_refresh(rows, name, **spec(second))
    else:
        assert tables.full_refresh(rows, name) == 1000
    assert spark.table(name).join(spark.table(other), "id").count() == 1000


def test_a_reload_of_another_type_is_refused(spark):
    name = f"t_{uuid.uuid4().hex}"
    tables.full_refresh(spark.range(10), name)
    with pytest.raises(ContractError):
        tables.full_refresh(spark.range(5).select(F.col("id").cast("string")), name)
    assert spark.table(name).count() == 10


def test_landed_text_keeps_its_blanks(spark):
    path = tables.land(spark.createDataFrame([(" 5", "x "), (None, " ")], "code string, name string"), new_path(spark, "blanks"))
    back = landed.read_long_csv(spark, path, {"code": ["code"], "name": ["name"]})
    assert {tuple(r) for r in back.collect()} == {(" 5", "x "), (None, " ")}


def test_bulk_text_is_landed_compressed_and_read_in_its_order(spark):
    rows = [(f"{i:05d}", "the same words in every row") for i in range(3000)]
    feed = spark.createDataFrame(rows, "code string, name string").repartitionByRange(4, "code").sortWithinPartitions("code")
    plain, packed = (tables.land(feed, new_path(spark, "bulk"), compression=c) for c in (None, "gzip"))
    found = landed.read_long_csv(spark, packed, {"code": ["code"], "name": ["name"]}, ordinal=True)
    assert [r.code for r in found.orderBy(landed.ORDINAL).collect()] == [c for c, _ in rows]
    size = lambda path: sum(f.stat().st_size for f in Path(path.removeprefix("file:")).glob("part-*"))
    assert size(packed) * 4 < size(plain)


def test_lines_travel_twice_before_they_are_landed(spark, tmp_path, monkeypatch):
    """To their parts and into their order, not to their suppliers, and not yet as two rows of text; beyond the bound they travel to suppliers, too."""
    from workload import fixtures as X

    stamp = "timestamp'1996-02-03 00:00:00'"
    spark.range(200).selectExpr(
        "id div 4 as l_orderkey", "cast(id % 4 as int) as l_linenumber", "id % 7 as l_partkey", "id % 5 as l_suppkey", f"{stamp} as l_shipdate", "double(id) as l_quantity",
        "id * 1.5d as l_extendedprice", "id % 3 * 0.1d as l_discount", "id % 2 * 0.1d as l_tax", "element_at(array('R', 'A', 'N'), cast(id % 3 + 1 as int)) as l_returnflag", "'O' as l_linestatus",
    ).orderBy(F.rand(1)).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(6).selectExpr("id as p_partkey", "if(id % 2 = 0, 'ECONOMY', 'SMALL') as p_type").write.parquet(f"{tmp_path}/part.parquet")  # of one part nothing is known
    spark.range(5).selectExpr("id as s_suppkey", "id % 3 as s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(3).selectExpr("id as n_nationkey", "concat('NATION', id) as n_name").write.parquet(f"{tmp_path}/nation.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        near = X.ordered_lines(spark, str(tmp_path))
        wide = [line for line in near._jdf.queryExecution().sparkPlan().toString().splitlines() if "SortMergeJoin" in line]
        assert len([line for line in wide if "l_partkey" in line]) == 1 and not any("l_suppkey" in line for line in wide)
        assert "Generate" not in near._jdf.queryExecution().sparkPlan().toString()
        monkeypatch.setattr(X, "NEAR_SUPPLIERS", 4)
        far = X.ordered_lines(spark, str(tmp_path))
        order = lambda df: [tuple(r) for r in df.select(*X.LONG_ORDER, "p_type", "n_nationkey", "n_name").collect()]
        assert order(near) == order(far) == sorted(order(near)) and len(order(near)) == 172
        text = lambda df: sorted(map(repr, df.collect()))
        assert text(X.long_rows(near)) == text(X.supply_long(spark, str(tmp_path)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
