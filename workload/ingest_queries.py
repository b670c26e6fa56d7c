"""Source, sink, cleaning, quality and scalar-function queries."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneloom.functions import scalars as S
from paneloom.operators import clean as C
from paneloom.operators import quality as Q
from paneloom.operators import summary as SM
from paneloom.plans import ingest
from paneloom.sources import landed, schemas, tables
from paneloom.store import materialise, new_path
from workload import fixtures as X
from workload.common import Registry, tidy
from workload.sql import CLEAN_CODE, CODES, LONG, LONG_ORDER, panel_cte, r, supply_cte, with_

registry = Registry()
add = registry.add

PAGE_ROWS = 500


# ---- sources ------------------------------------------------------------------------------

ORDER_ROW = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)
ORDER_SQL = f"select o_orderkey, o_custkey, o_orderstatus, {r('o_totalprice')} as o_totalprice, o_orderpriority from orders"


@add("src_json_pages", ORDER_SQL)
def src_json_pages(spark, folder):
    """All orders landed as feed pages (one JSON object per line), read back as rows."""
    path = new_path(spark, "pages")
    numbered = X.table(spark, folder, "orders").select(
        F.floor(F.monotonically_increasing_id() / PAGE_ROWS).alias("page"), F.struct(*ORDER_ROW.names).alias("row")
    )
    pages = numbered.groupBy("page").agg(F.collect_list("row").alias("value"))
    link = F.concat(F.lit("page/"), (F.col("page") + 1).cast("string")).alias(landed.NEXT_LINK)
    pages.select(F.to_json(F.struct("value", link))).write.text(path)
    return tidy(landed.read_json_pages(spark, path, ORDER_ROW))


@add("src_xml_catalog", f"select p_partkey, p_name, p_brand, p_type, cast(p_size as bigint) as p_size, {r('p_retailprice')} as p_retailprice from part")
def src_xml_catalog(spark, folder):
    """All parts landed as an XML catalogue, one element per part, read back by row tag."""
    path = new_path(spark, "catalogue")
    parts = X.table(spark, folder, "part")
    parts.write.format("xml").option("rootTag", "Datasets").option("rowTag", "Dataset").save(path)
    rows = landed.read_xml_catalogue(spark, path, "Dataset", parts.columns)
    numbers = C.coerce_numeric(rows, ["p_partkey", "p_size", "p_retailprice"])
    return tidy(numbers.withColumns({c: F.col(c).cast("bigint") for c in ("p_partkey", "p_size")}))


@add(
    "catalog_pick",
    f"""select p_partkey, p_name, p_brand, p_type, cast(p_size as bigint) as p_size, {r('p_retailprice')} as p_retailprice from (
  select *, concat_ws(' ', p_partkey, p_name, p_brand, p_type, p_size, p_retailprice) as t from part)
where t ilike '%promo%' or t ilike '%small%'
order by case when regexp_matches(t, '(?i)promo') then 0 else 1 end, p_partkey limit 1""",
)
def catalog_pick(spark, folder):
    parts = X.table(spark, folder, "part")
    return tidy(landed.pick_dataset(parts, ["promo", "small"], "promo", "p_partkey", "p_name"))


LONG_COLUMNS = ["code", "area", "item", "element", "period", "unit", "value"]


@add("scan_long_pruned", with_(LONG) + f"select {', '.join(LONG_COLUMNS)} from long")
def scan_long_pruned(spark, folder):
    """The long rows landed as a bulk file with columns nobody asked for; the scan parses seven of nine."""
    path = new_path(spark, "long")
    rows = X.supply_long(spark, folder).select(F.lit(9).alias("Area Code"), *LONG_COLUMNS, F.lit("note").alias("Note"))
    tables.land(rows, path)
    return landed.read_long_csv(spark, path, {c: [c.title()] if c != "code" else ["M49", "code"] for c in LONG_COLUMNS})


@add(
    "scan_alias_columns",
    f"""select l_suppkey as code, l_returnflag as item, l_linestatus as element, {r('l_extendedprice')} as value, count(*) as row_count
from lineitem group by all""",
)
def scan_alias_columns(spark, folder):
    """A landed bulk file with other header spellings and columns nobody asked for."""
    path = new_path(spark, "bulk")
    lines = X.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("Flag"),
        F.col("l_suppkey").alias("area code"),
        F.col("l_returnflag").alias("ITEM"),
        F.col("l_linestatus").alias("Element "),
        F.col("l_extendedprice").alias("Value"),
    )
    tables.land(lines, path)
    wanted = {"code": ["Area Code (M49)", "Area Code"], "item": ["Item"], "element": ["Element"], "value": ["Value"]}
    rows = C.coerce_numeric(landed.read_long_csv(spark, path, wanted), ["code", "value"])
    counted = rows.withColumn("code", F.col("code").cast("bigint")).groupBy(*wanted).agg(F.count("*").alias("row_count"))
    return tidy(counted)


@add("src_csv_contract", f"select c_custkey, c_name, cast(c_nationkey as bigint) as c_nationkey, {r('c_acctbal')} as c_acctbal, c_mktsegment from customer")
def src_csv_contract(spark, folder):
    path = new_path(spark, "csv")
    customers = X.table(spark, folder, "customer")
    tables.land(customers.select(*reversed(customers.columns)), path)
    return tidy(landed.read_csv_table(spark, path, customers.schema))


# ---- sinks --------------------------------------------------------------------------------


@add("sink_roundtrip", ORDER_SQL)
def sink_roundtrip(spark, folder):
    path = new_path(spark, "landed")
    tables.land(X.table(spark, folder, "orders").select(*ORDER_ROW.names), path)
    return tidy(landed.read_csv_table(spark, path, ORDER_ROW))


@add(
    "full_refresh_load",
    f"select entity, period, b, {r('b2')} as b2, (select count(*) from ("
    + with_(supply_cte())
    + "select * from supply where b is not null)) as first_load, count(*) over () as second_load from ("
    + with_(supply_cte())
    + "select * from supply)",
)
def full_refresh_load(spark, folder):
    """Loaded twice; the second load replaces the first as a whole. Both report their rows."""
    name = f"supply_{uuid.uuid4().hex}"
    supply = X.supply(spark, folder)
    root = new_path(spark, "tables")
    first = tables.full_refresh(supply.where("b is not null"), name, root, key=["entity", "period"])
    second = tables.full_refresh(supply, name, root, key=["entity", "period"])
    return tidy(spark.table(name).withColumns({"first_load": F.lit(first), "second_load": F.lit(second)}))


@add(
    "full_refresh_readers",
    with_(supply_cte())
    + f"""select entity, period, {r('b')} as b, (select count(*) from supply) as reloaded, 1 as retired, 1 as swept
from supply where b is not null""",
)
def full_refresh_readers(spark, folder):
    """A scan begun before a reload, read after it: the old rows, until their generation is swept."""
    name = f"supply_{uuid.uuid4().hex}"
    supply, root = X.supply(spark, folder), new_path(spark, "tables")
    tables.full_refresh(supply.where("b is not null"), name, root, key=["entity", "period"])
    begun = spark.table(name)
    tables.full_refresh(supply, name, root, key=["entity", "period"])
    retired = sum(at is not None for at in tables.generations(spark, name).values())
    seen = materialise(begun, "scan")
    swept = len(tables.sweep(spark, name, older_than=0))
    return tidy(
        seen.select("entity", "period", "b").withColumns(
            {"reloaded": F.lit(spark.table(name).count()), "retired": F.lit(retired), "swept": F.lit(swept)}
        )
    )


@add("sorted_sink", f"select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, {r('l_quantity')} as l_quantity from lineitem")
def sorted_sink(spark, folder):
    lines = X.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return tidy(materialise(C.sorted_for_sink(lines, ["l_orderkey", "l_linenumber"]), "sorted"))


@add(
    "union_chunks",
    f"""select o_orderkey, cast(year(o_orderdate) as bigint) as period, {r('o_totalprice')} as o_totalprice, chunk
from (select *, case when year(o_orderdate) < 1998 then 'early' else 'late' end as chunk from orders)""",
)
def union_chunks(spark, folder):
    orders = X.table(spark, folder, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("period"), "o_totalprice"
    )
    early = orders.where("period < 1998").withColumn("chunk", F.lit("early"))
    late = orders.where("period >= 1998").withColumn("chunk", F.lit("late"))
    return tidy(C.union_all([early, late]))


@add("sorted_sink_order", "select count(*) as row_count, 0::bigint as inversions, 0::bigint as overlaps from lineitem")
def sorted_sink_order(spark, folder):
    """Rows out of order within the written files, and files that overlap the one before."""
    key = ["l_orderkey", "l_linenumber"]
    lines = X.table(spark, folder, "lineitem").select(*key)
    stored = materialise(C.sorted_for_sink(lines, key), "sorted")
    placed = stored.select(F.struct(*key).alias("key"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    before = F.lag("key").over(Window.partitionBy("file").orderBy("at"))
    files = (
        placed.withColumn("inverted", before > F.col("key"))
        .groupBy("file")
        .agg(F.count("*").alias("n"), F.count_if("inverted").alias("inverted"), F.min("key").alias("low"), F.max("key").alias("high"))
    )
    overlap = F.lag("high").over(Window.orderBy("file")) > F.col("low")  # one row per file
    return files.withColumn("overlaps", overlap).agg(
        F.sum("n").alias("row_count"), F.sum("inverted").alias("inversions"), F.count_if("overlaps").alias("overlaps")
    )


# ---- contracts and quality ----------------------------------------------------------------


@add(
    "contract_columns",
    """select o_orderstatus, count(*) as row_count, 'o_clerk, o_comment' as missing_columns from orders group by o_orderstatus""",
)
def contract_columns(spark, folder):
    orders = X.table(spark, folder, "orders")
    missing = Q.missing_columns(orders, ["o_orderkey", "o_clerk", "o_orderstatus", "o_comment"])
    checked = Q.require_columns(orders, ["o_orderkey", "o_orderstatus"])
    counted = checked.groupBy("o_orderstatus").agg(F.count("*").alias("row_count"))
    return tidy(counted.withColumn("missing_columns", F.lit(", ".join(missing))))


@add(
    "constraint_violations",
    """select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, count(*) as row_count, 0::bigint as null_count
from lineitem group by l_orderkey, l_linenumber having count(*) > 1""",
)
def constraint_violations(spark, folder):
    return tidy(Q.key_violations(X.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"]))


@add(
    "constraint_null_keys",
    """select status, priority, count(*) as row_count, count(*) filter (priority is null) as null_count
from (select o_orderstatus as status, case when o_orderstatus <> 'P' then o_orderpriority end as priority from orders)
group by status, priority having count(*) > 1 or count(*) filter (priority is null) > 0""",
)
def constraint_null_keys(spark, folder):
    status = F.col("o_orderstatus")
    rows = X.table(spark, folder, "orders").select(
        status.alias("status"), F.when(status != "P", F.col("o_orderpriority")).alias("priority")
    )
    return tidy(Q.key_violations(rows, ["status", "priority"]))


RAW_CODE = "case when c_acctbal < 1000 then c_mktsegment else ' ' || lower(substr(c_mktsegment, 1, 3)) || ' ' end"


def _coded_customers(spark, folder):
    segment = F.col("c_mktsegment")
    short = F.concat(F.lit(" "), F.lower(F.substring(segment, 1, 3)), F.lit(" "))
    customers = X.table(spark, folder, "customer")
    return customers.withColumn("code", F.when(F.col("c_acctbal") < 1000, segment).otherwise(short))


@add(
    "load_accounting",
    f"""select count(*) as rows_before, count(*) filter (ok) as rows_after, count(*) filter (not ok) as rows_removed,
  count(distinct code) filter (ok) as entities, cast(min(c_nationkey) filter (ok) as bigint) as min_period, cast(max(c_nationkey) filter (ok) as bigint) as max_period
from (select *, regexp_full_match(code, '[A-Z]{{3}}') as ok from (select *, trim(upper({RAW_CODE})) as code from customer))""",
)
def load_accounting(spark, folder):
    rows = C.normalise_keys(_coded_customers(spark, folder), ["code"])
    return tidy(Q.load_accounting(rows, S.is_alpha3(F.col("code")), "code", "c_nationkey"))


# ---- projection, coercion, filters --------------------------------------------------------


@add(
    "project_rename",
    f"""select o_orderkey as id, o_custkey as entity, o_orderstatus as status, {r('o_totalprice')} as amount,
  o_orderpriority as category from orders""",
)
def project_rename(spark, folder):
    names = {
        "o_orderkey": "id",
        "o_custkey": "entity",
        "o_orderstatus": "status",
        "o_totalprice": "amount",
        "o_orderpriority": "category",
    }
    return tidy(C.project_rename(X.table(spark, folder, "orders"), names))


@add(
    "recode_passthrough",
    """select o_orderkey, o_orderstatus, case o_orderstatus when 'F' then 'Final' when 'O' then 'Open' else o_orderstatus end as status
from orders""",
)
def recode_passthrough(spark, folder):
    orders = X.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return tidy(C.recode_passthrough(orders, "o_orderstatus", "status", {"F": "Final", "O": "Open"}))


BRAND_TEXT = """case p_type when 'PROMO' then p_brand when 'SMALL' then ' ' || replace(p_brand, 'Brand#', '') || '.5 '
  else replace(p_brand, 'Brand#', '') end"""


def _text_parts(spark, folder):
    bare = F.regexp_replace("p_brand", "Brand#", "")
    text = (
        F.when(F.col("p_type") == "PROMO", F.col("p_brand"))
        .when(F.col("p_type") == "SMALL", F.concat(F.lit(" "), bare, F.lit(".5 ")))
        .otherwise(bare)
    )
    parts = X.table(spark, folder, "part")
    return parts.select(
        "p_partkey", text.alias("brand_no"), F.concat(F.col("p_size").cast("string"), F.lit(".0")).alias("size_no")
    )


@add("numeric_coerce", f"select p_partkey, {r(f'try_cast(trim({BRAND_TEXT}) as double)')} as brand_no from part")
def numeric_coerce(spark, folder):
    return tidy(C.coerce_numeric(_text_parts(spark, folder).drop("size_no"), ["brand_no"]))


@add(
    "numeric_coerce_known",
    f"select p_partkey, {r(f'try_cast(trim({BRAND_TEXT}) as double)')} as brand_no, cast(p_size as double) as size_no from part",
)
def numeric_coerce_known(spark, folder):
    return tidy(C.coerce_known_numeric(_text_parts(spark, folder), ["size_no", "price_no", "brand_no"]))


@add("cast_columns", "select p_partkey, cast(p_size as bigint) as size_no from part")
def cast_columns(spark, folder):
    parts = C.coerce_numeric(_text_parts(spark, folder).drop("brand_no"), ["size_no"])
    return tidy(C.periods_to_int(parts, "size_no"))


@add("key_normalise", f"select c_custkey, trim(upper({RAW_CODE})) as code from customer")
def key_normalise(spark, folder):
    return tidy(C.normalise_keys(_coded_customers(spark, folder), ["code"]).select("c_custkey", "code"))


@add(
    "code_fullmatch_filter",
    f"""select c_custkey, code from (select c_custkey, trim(upper({RAW_CODE})) as code from customer)
where regexp_full_match(code, '[A-Z]{{3}}')""",
)
def code_fullmatch_filter(spark, folder):
    rows = C.normalise_keys(_coded_customers(spark, folder), ["code"])
    return tidy(C.keep_alpha3(rows, "code").select("c_custkey", "code"))


@add("dropna_subset", with_(supply_cte()) + f"select entity, period, b, {r('b2')} as b2 from supply where b is not null and b2 is not null")
def dropna_subset(spark, folder):
    return tidy(C.drop_missing(X.supply(spark, folder), ["b", "b2"]))


DEDUP_ORDER = "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"


@add(
    "dedup_keep_first",
    f"""select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_partkey, l_suppkey, {r('l_quantity')} as l_quantity,
  {r('l_extendedprice')} as l_extendedprice, {r('l_discount')} as l_discount, {r('l_tax')} as l_tax, l_returnflag, l_linestatus,
  cast(l_shipdate as date) as l_shipdate
from (select *, row_number() over (partition by l_orderkey, l_linenumber order by {DEDUP_ORDER}) as rn from lineitem) where rn = 1""",
)
def dedup_keep_first(spark, folder):
    first = C.keep_first(
        X.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], DEDUP_ORDER.split(", ")
    )
    return tidy(first.withColumn("l_shipdate", F.to_date("l_shipdate")))


@add(
    "code_lookup",
    with_(LONG, CODES)
    + f"""select l.code, l.period, c.area_entity, count(*) as row_count from (select *, {CLEAN_CODE} as clean from long) l
left join codes c on l.clean = c.code group by all""",
)
def code_lookup(spark, folder):
    """Every row is looked up; the result counts rows per spelling, period and found entity."""
    long = X.supply_long(spark, folder)
    found = C.lookup_codes(long, "code", X.code_dimension(spark, folder), "code", "area_entity", "area_entity")
    return tidy(found.groupBy("code", "period", "area_entity").agg(F.count("*").alias("row_count")))


@add(
    "filter_item_element",
    with_(LONG)
    + """select item, element, unit, period, count(*) as row_count from long
where lower(item) like '%econ%' and element in ('quantity', 'price') group by all""",
)
def filter_item_element(spark, folder):
    kept = C.keep_items(X.supply_long(spark, folder), "item", "econ", "element", ["quantity", "price"])
    return tidy(kept.groupBy("item", "element", "unit", "period").agg(F.count("*").alias("row_count")))


PIVOT = f"""kept as (
  select c.area_entity, l.area, cast(try_cast(l.period as double) as bigint) as period, l.element,
    try_cast(trim(l.value) as double) as value, {LONG_ORDER}
  from (select *, {CLEAN_CODE} as clean from long) l join codes c on l.clean = c.code),
firsts as (
  select area_entity, area, period, element, value from (
    select *, row_number() over (partition by area_entity, area, period, element order by {LONG_ORDER}) as rn
    from kept where value is not null) where rn = 1),
wide as (
  select area_entity, area, period, max(value) filter (element = 'quantity') as quantity_supply,
    max(value) filter (element = 'price') as price_supply from firsts group by area_entity, area, period)"""


def _pivoted(spark, folder):
    long = X.supply_long(spark, folder)
    found = C.lookup_codes(long, "code", X.code_dimension(spark, folder), "code", "area_entity", "area_entity")
    typed = C.periods_to_int(C.coerce_numeric(found, ["period", "value"]), "period")
    kept = C.drop_missing(typed, ["area_entity", "period", "value"])
    return C.pivot_first(kept, ["area_entity", "area", "period"], "element", "value", F.col("ordinal"), X.SUPPLY_ELEMENTS)


@add(
    "pivot_first",
    with_(LONG, CODES, PIVOT)
    + f"select area_entity, area, period, {r('quantity_supply')} as quantity_supply, {r('price_supply')} as price_supply from wide",
)
def pivot_first(spark, folder):
    return tidy(_pivoted(spark, folder))


EXPECTED = T.StructType(
    [
        T.StructField("area_entity", T.StringType()),
        T.StructField("period", T.IntegerType()),
        T.StructField("price_supply", T.DoubleType()),
        T.StructField("energy_supply", T.DoubleType()),
    ]
)


@add(
    "ensure_columns",
    with_(LONG, CODES, PIVOT)
    + f"select area_entity, period, {r('price_supply')} as price_supply, cast(null as double) as energy_supply from wide",
)
def ensure_columns(spark, folder):
    return tidy(C.ensure_columns(_pivoted(spark, folder), EXPECTED))


# ---- from landed feeds to the base tables ---------------------------------------------------

LETTERS = " || ".join(f"chr((65 + (o_custkey // {n}) % 26)::int)" for n in (676, 26, 1))


@add(
    "ingest_prevalence",
    f"""with feed as (
  select o_orderkey, {LETTERS} || case when o_orderpriority = '4-NOT SPECIFIED' then '1' else '' end as iso3,
    cast(year(o_orderdate) as bigint) as year, case o_orderpriority when '1-URGENT' then 'SEX_FMLE' when '5-LOW' then 'SEX_MLE'
      when '2-HIGH' then 'SEX_OTHER' else 'SEX_BTSX' end as sex_code, o_totalprice, o_orderstatus from orders),
firsts as (
  select *, row_number() over (partition by iso3, year, sex_code order by o_orderkey) as rn from feed where o_totalprice >= 20000)
select iso3, year, case sex_code when 'SEX_FMLE' then 'Female' when 'SEX_MLE' then 'Male' when 'SEX_BTSX' then 'Both sexes'
    else sex_code end as sex, sex_code, {r('o_totalprice')} as obesity_pct, {r('o_totalprice - 1')} as obesity_pct_low,
  {r('o_totalprice + 1')} as obesity_pct_high, 'Region ' || o_orderstatus as who_region, o_orderstatus as who_region_code
from firsts where rn = 1 and regexp_full_match(iso3, '[A-Z]{{3}}')""",
)
def ingest_prevalence(spark, folder):
    """All orders landed as pages of the prevalence feed in the order of their keys, cleaned and made loadable."""
    path = new_path(spark, "prevalence")
    row = F.struct("o_orderkey", F.struct(*schemas.PREVALENCE_FEED.names).alias("row"))
    feed = X.prevalence_feed(spark, folder).withColumn("page", F.floor(F.col("o_orderkey") / PAGE_ROWS))
    pages = feed.groupBy("page").agg(F.array_sort(F.collect_list(row)).alias("rows")).orderBy("page")
    pages.select(F.to_json(F.struct(F.col("rows.row").alias("value")))).write.text(path)
    raw = landed.read_json_pages(spark, path, schemas.PREVALENCE_FEED, ordinal=True)
    return tidy(ingest.loadable_prevalence(ingest.clean_prevalence(raw)))


FIRST_SUPPLY = f"""codes as (select lpad(cast(n_nationkey as varchar), 3, '0') as code, upper(left(n_name, 3)) as iso3 from nation),
firsts as (
  select *, row_number() over (partition by iso3, area, year, element order by {LONG_ORDER}) as rn
  from (select c.iso3, l.*, cast(try_cast(l.period as double) as bigint) as year, try_cast(trim(l.value) as double) as number
    from (select *, {CLEAN_CODE} as clean from long where item = 'ECONOMY') l join codes c on l.clean = c.code)
  where number is not null)"""


@add(
    "ingest_supply",
    with_(LONG, FIRST_SUPPLY)
    + f"""select iso3, area as country, year, {r("max(number) filter (element = 'quantity')")} as sugar_supply_kg_per_capita,
  {r("max(number) filter (element = 'price')")} as sugar_supply_kcal_per_capita_day
from firsts where rn = 1 and regexp_full_match(iso3, '[A-Z]{{3}}') group by iso3, area, year""",
)
def ingest_supply(spark, folder):
    """All line items landed as the supply feed's bulk CSV in their order, cleaned, pivoted and made loadable.

    Lines are put in order before each becomes two rows of text, and the text is landed compressed.
    """
    path = new_path(spark, "supply")
    elements = dict(zip(X.SUPPLY_ELEMENTS, schemas.SUPPLY_ELEMENTS, strict=True))
    item = F.when(F.col("item") == "ECONOMY", F.lit(f"Raw {schemas.SUPPLY_ITEM.lower()}")).otherwise(F.col("item"))
    feed = X.long_rows(X.ordered_lines(spark, folder)).select(
        F.lit(9).alias("Area Code"),
        F.col("code").alias("Area Code (M49)"),
        F.col("area").alias("Area"),
        item.alias("Item"),
        S.recode(F.col("element"), elements).alias("Element"),
        F.col("period").alias("Year"),
        F.col("unit").alias("Unit"),
        F.col("value").alias("Value"),
        F.lit("note").alias("Note"),
    )
    tables.land(feed, path, compression="gzip")
    long = landed.read_long_csv(spark, path, schemas.SUPPLY_ALIASES, ordinal=True)
    codes = X.code_dimension(spark, folder).select("code", F.left("area_entity", F.lit(3)).alias("iso3"))
    return tidy(ingest.loadable_supply(ingest.clean_supply(long, codes)))


# ---- scalar functions ---------------------------------------------------------------------


@add(
    "round_half_up",
    """select o_orderkey, cast(round(cast(o_totalprice as decimal(18, 2)), 1) as double) as price_1 from orders""",
)
def round_half_up(spark, folder):
    rows = X.table(spark, folder, "orders").select("o_orderkey", F.col("o_totalprice").alias("price_1"))
    return SM.rounded(rows, {"price_1": 1}, half_even=False)


@add(
    "round_half_even",
    """select o_orderkey, (cents // 10 + case when cents % 10 > 5 or (cents % 10 = 5 and (cents // 10) % 2 = 1) then 1 else 0 end) / 10::double as price_1
from (select o_orderkey, cast(round(o_totalprice * 100) as bigint) as cents from orders)""",
)
def round_half_even(spark, folder):
    rows = X.table(spark, folder, "orders").select("o_orderkey", F.col("o_totalprice").alias("price_1"))
    return SM.rounded(rows, {"price_1": 1})


@add(
    "string_scalars",
    """select p_partkey, trim(upper(' ' || p_name || ' ')) as upper_name, regexp_replace('''' || cast(p_size as varchar) || '.0', '''|\\.0$', '', 'g') as bare_code,
  case when length(cast(p_size as varchar)) < 3 then lpad(cast(p_size as varchar), 3, '0') else cast(p_size as varchar) end as code,
  p_type ilike '%promo%' or p_type ilike '%small%' as wanted, regexp_full_match(upper(p_name), '[A-Z]{3} .*') as short_first from part""",
)
def string_scalars(spark, folder):
    size = F.col("p_size").cast("string")
    spelled = F.concat(F.lit("'"), size, F.lit(".0"))
    return X.table(spark, folder, "part").select(
        "p_partkey",
        S.normalise_key(F.concat(F.lit(" "), F.col("p_name"), F.lit(" "))).alias("upper_name"),
        F.regexp_replace(spelled, r"'|\.0\z", "").alias("bare_code"),
        S.canonical_numeric_code(spelled).alias("code"),
        S.contains_any(F.col("p_type"), ["promo", "small"]).alias("wanted"),
        F.upper("p_name").rlike(r"\A[A-Z]{3} .*\z").alias("short_first"),
    )


@add(
    "flag_parse",
    """select o_orderkey, lower(flag) in ('true', '1') as is_set from (
  select o_orderkey, case o_orderstatus when 'F' then 'True' when 'O' then left(o_orderpriority, 1) else 'false' end as flag from orders)""",
)
def flag_parse(spark, folder):
    status = F.col("o_orderstatus")
    flag = (
        F.when(status == "F", F.lit("True"))
        .when(status == "O", F.substring("o_orderpriority", 1, 1))
        .otherwise(F.lit("false"))
    )
    return X.table(spark, folder, "orders").select("o_orderkey", S.parse_flag(flag).alias("is_set"))


@add(
    "clip_scalar",
    with_(supply_cte())
    + f"""select entity, period, {r('case when b2 is not null then greatest(30000, least(60000, b2)) end')} as clipped from supply""",
)
def clip_scalar(spark, folder):
    return tidy(
        X.supply(spark, folder).select("entity", "period", S.clip(F.col("b2"), 30_000.0, 60_000.0).alias("clipped"))
    )


@add(
    "fillna_mean",
    with_(supply_cte())
    + f"select entity, period, b, {r('coalesce(b, (select avg(b) from supply))')} as filled from supply",
)
def fillna_mean(spark, folder):
    supply = materialise(X.supply(spark, folder).select("entity", "period", "b"), "supply")
    return tidy(SM.fill_with(supply, "b", supply.agg(F.avg("b")).scalar(), "filled"))


@add(
    "scenario_ramp",
    with_(panel_cte())
    + f"""select p.entity, p.period, f.forecast_period, {r('case when 2004 <= p.period then p.b else p.b * (1 + -0.1 * greatest(0::double, least(1::double, (f.forecast_period - p.period)::double / (2004 - p.period)))) end')} as b_assumption
from panel p cross join (select unnest(range(2000, 2007)) as forecast_period) f""",
)
def scenario_ramp(spark, folder):
    """Every panel row ramped to seven periods around the end of the scenario."""
    rows = X.panel(spark, folder).select("entity", "period", "b")
    stepped = rows.withColumn("forecast_period", F.explode(F.sequence(F.lit(2000), F.lit(2006))))
    ramp = S.ramp(F.col("b"), F.lit(-0.1), F.col("forecast_period"), F.col("period"), F.lit(2004))
    return tidy(stepped.select("entity", "period", "forecast_period", ramp.alias("b_assumption")))
