"""Panel-shaped inputs derived by Spark from the whole star-schema tables.

Two entity levels, both growing with the data:

* customer x year: sparse, with natural gaps, heavy ties and NULL metrics;
* supplier x quarter: dense, for lag-3/lead-3 features and training.

metric a   = 100 * share of orders with status F (0..100), with a 95% band
metric b   = quantity of lines that were not kept (return flag other than N); may be NULL
metric b2  = mean price of open lines; may be NULL
group      = region of the entity
category   = order priority, plus the aggregate over all orders
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paneloom import roles as R
from paneloom.functions.scalars import recode
from paneloom.operators.clean import recode_passthrough, sorted_for_sink
from paneloom.operators.panel import panel_join
from paneloom.store import deal

ALL = "ALL"
CATEGORY_LABELS = {ALL: "All orders", "1-URGENT": "Urgent", "5-LOW": "Low"}
FIRST_YEAR = 1995


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def period_of(when: Column, grain: str) -> Column:
    if grain == "year":
        return F.year(when)
    return (F.year(when) - F.lit(FIRST_YEAR)) * 4 + F.quarter(when)


def entity_dims(spark: SparkSession, folder: str, level: str = "customer") -> DataFrame:
    nation = table(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, folder, "region").select("r_regionkey", "r_name")
    key, name, nationkey = {
        "customer": ("c_custkey", "c_name", "c_nationkey"),
        "supplier": ("s_suppkey", "s_name", "s_nationkey"),
    }[level]
    return (
        table(spark, folder, level)
        .join(nation, F.col(nationkey) == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col(key).alias(R.ENTITY),
            F.col(name).alias(R.NAME),
            F.col("r_name").alias(R.GROUP),
            F.col("r_regionkey").alias(R.GROUP_CODE),
        )
    )


def _order_facts(spark: SparkSession, folder: str, level: str, grain: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    facts = [
        period_of(F.col("o_orderdate"), grain).alias(R.PERIOD),
        F.col("o_orderpriority").alias(R.CATEGORY_CODE),
        (F.col("o_orderstatus") == "F").alias("final"),
    ]
    if level == "customer":
        return orders.select(F.col("o_custkey").alias(R.ENTITY), *facts)
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_suppkey").alias(R.ENTITY), *facts
    )


def order_periods(spark: SparkSession, folder: str, grain: str = "year") -> DataFrame:
    """Just the periods of the observations, for bounds: one column of a scan, nothing to shuffle."""
    return table(spark, folder, "orders").select(period_of(F.col("o_orderdate"), grain).alias(R.PERIOD))


def _share(facts: DataFrame, *category: Column) -> DataFrame:
    counted = facts.groupBy(R.ENTITY, R.PERIOD, *category).agg(
        F.count("*").alias("n"), F.count_if("final").alias("f")
    )
    a, p = F.lit(100.0) * F.col("f") / F.col("n"), F.col("f") / F.col("n")
    half = F.lit(196.0) * F.sqrt(p * (F.lit(1.0) - p) / F.col("n"))
    return counted.withColumns(
        {
            R.METRIC_A: a,
            R.METRIC_A_LOW: F.greatest(F.lit(0.0), a - half),
            R.METRIC_A_HIGH: F.least(F.lit(100.0), a + half),
        }
    ).drop("n", "f")


def all_orders(spark: SparkSession, folder: str, level: str = "customer", grain: str = "year") -> DataFrame:
    """The aggregate category only: (entity, period) is unique."""
    return _share(_order_facts(spark, folder, level, grain))


def observations(spark: SparkSession, folder: str, level: str = "customer", grain: str = "year") -> DataFrame:
    """Long prevalence-like fact, key (entity, period, category_code).

    A union, so a filter on the category prunes the branch that cannot match.
    """
    facts = _order_facts(spark, folder, level, grain)
    members = _share(facts, F.col(R.CATEGORY_CODE))
    total = _share(facts).withColumn(R.CATEGORY_CODE, F.lit(ALL))
    long = recode_passthrough(members.unionByName(total), R.CATEGORY_CODE, R.CATEGORY, CATEGORY_LABELS)
    dims = entity_dims(spark, folder, level).select(R.ENTITY, R.GROUP, R.GROUP_CODE)
    return long.join(dims, R.ENTITY)


def supply(spark: SparkSession, folder: str, level: str = "customer", grain: str = "year") -> DataFrame:
    lines = table(spark, folder, "lineitem")
    if level == "customer":
        orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
        lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    key = F.col("o_custkey" if level == "customer" else "l_suppkey")
    return (
        lines.groupBy(key.alias(R.ENTITY), period_of(F.col("l_shipdate"), grain).alias(R.PERIOD))
        .agg(
            F.sum(F.when(F.col("l_returnflag") != "N", F.col("l_quantity"))).alias(R.METRIC_B),
            F.avg(F.when(F.col("l_linestatus") == "O", F.col("l_extendedprice"))).alias(R.METRIC_B2),
        )
    )


def panel(spark: SparkSession, folder: str, level: str = "customer", grain: str = "year") -> DataFrame:
    """Both facts joined on (entity, period), with the entity's name and group."""
    facts = panel_join(all_orders(spark, folder, level, grain), supply(spark, folder, level, grain))
    return facts.join(entity_dims(spark, folder, level), R.ENTITY).select(
        R.ENTITY, R.NAME, R.PERIOD, "a", "a_low", "a_high", "b", "b2", R.GROUP, R.GROUP_CODE
    )


SUPPLY_ELEMENTS = {"quantity": "quantity_supply", "price": "price_supply"}
LONG_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]


#: Suppliers up to which their nations are looked up where the lines lie, by some 100 MB in each executor; more are joined by a shuffle.
NEAR_SUPPLIERS = 1_000_000


def typed_lines(spark: SparkSession, folder: str, dealt: bool = True) -> DataFrame:
    """Line items with the type of their part; not ``dealt`` where the rows are dealt out anew anyway."""
    lines = table(spark, folder, "lineitem").select(*LONG_ORDER)
    part = table(spark, folder, "part").select("p_partkey", "p_type")
    return (deal(lines) if dealt else lines).join(part, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey")


def with_nation(lines: DataFrame, folder: str, near: bool = False) -> DataFrame:
    """``lines`` with the nation of their supplier; ``near`` leaves them where they are, in their order."""
    spark = lines.sparkSession
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    placed = supplier.select("s_suppkey", "n_nationkey", "n_name")
    return lines.join(F.broadcast(placed) if near else placed, F.col("l_suppkey") == F.col("s_suppkey")).drop("s_suppkey")


def ordered_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of ``long_rows`` in their order: wide rows travel to the join with their parts and once more to be put in order."""
    lines = typed_lines(spark, folder, dealt=False)
    if table(spark, folder, "supplier").count() <= NEAR_SUPPLIERS:
        placed = sorted_for_sink(lines, LONG_ORDER).withColumn("_place", F.monotonically_increasing_id())
        # Spark takes an order below a join for idle and drops it, but not below a column that depends on the rows' places.
        return with_nation(placed.where("_place >= 0"), folder, near=True).drop("_place")
    return sorted_for_sink(with_nation(lines, folder), LONG_ORDER)


def long_rows(lines: DataFrame) -> DataFrame:
    """Both elements of each line with its type and nation, in the order of the lines."""
    number = F.col("n_nationkey").cast("string")
    flag = F.col("l_returnflag")
    code = (
        F.when((flag == "R") & (F.col("l_tax") == 0), F.lit("999"))
        .when(flag == "A", F.concat(F.lit("'"), F.lpad(number, 3, "0")))
        .when(flag == "N", F.concat(number, F.lit(".0")))
        .otherwise(F.concat(F.lit(" "), number))
    )
    element = F.explode(
        F.array(
            F.struct(F.lit("quantity").alias("element"), F.lit("units").alias("unit"), F.col("l_quantity").alias("v")),
            F.struct(F.lit("price").alias("element"), F.lit("money").alias("unit"), F.col("l_extendedprice").alias("v")),
        )
    )
    return lines.withColumn("_e", element).select(
        code.alias("code"),
        F.col("n_name").alias("area"),
        F.col("p_type").alias("item"),
        F.col("_e.element").alias("element"),
        F.concat(F.year("l_shipdate").cast("string"), F.lit(".0")).alias("period"),
        F.col("_e.unit").alias("unit"),
        F.when(F.col("l_discount") == 0, F.lit("n/a")).otherwise(F.col("_e.v").cast("string")).alias("value"),
        F.struct(*LONG_ORDER).alias("ordinal"),
    )


def supply_long(spark: SparkSession, folder: str) -> DataFrame:
    """Raw long supply rows as a bulk file would carry them, two elements per line item.

    All fields are text. Area codes come in several spellings by return flag and are unknown
    (999) for untaxed returned lines; values of undiscounted lines are not numbers.
    """
    return long_rows(with_nation(typed_lines(spark, folder), folder))


def prevalence_feed(spark: SparkSession, folder: str) -> DataFrame:
    """A raw feed of one row per order under the public feed's field names, and the order's key.

    Entity codes are three letters made from the customer's key, in two spellings; unspecified
    orders carry a code that is no entity, and small ones no value. Keys repeat, so "first" matters.
    """
    k, price = F.col("o_custkey"), F.col("o_totalprice")
    code = F.concat(*[F.chr((F.floor(k / n) % 26 + 65).cast("int")) for n in (676, 26, 1)])
    code = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.concat(code, F.lit("1"))).otherwise(code)
    sex = recode(F.col("o_orderpriority"), {"1-URGENT": "SEX_FMLE", "5-LOW": "SEX_MLE", "2-HIGH": "SEX_OTHER"})
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit(" "), F.lower(code), F.lit(" "))).otherwise(code).alias("SpatialDim"),
        F.year("o_orderdate").alias("TimeDim"),
        F.when(sex.startswith("SEX_"), sex).otherwise(F.lit("SEX_BTSX")).alias("Dim1"),
        F.when(price >= 20_000, price).alias("NumericValue"),
        (price - 1).alias("Low"),
        (price + 1).alias("High"),
        F.concat(F.lit("Region "), F.col("o_orderstatus")).alias("ParentLocation"),
        F.col("o_orderstatus").alias("ParentLocationCode"),
    )


def code_dimension(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("code"), F.upper(F.col("n_name")).alias("area_entity")
    )
