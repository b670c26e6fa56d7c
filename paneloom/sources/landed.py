"""Landed files: paged JSON, XML catalogue, long CSV."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from paneloom.functions import scalars as S
from paneloom.operators.quality import ContractError, require_columns

NEXT_LINK = "@odata.nextLink"
ORDINAL = "_ordinal"


def file_ordinal() -> Column:
    """Position of a row in its landed files: file, split offset, row number within the task.

    Add it directly on a file scan. It is what "first" means for files: Spark itself keeps no
    row order across a shuffle.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("offset"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_json_pages(
    spark: SparkSession, path, row: T.StructType, whole_files: bool = False, ordinal: bool = False
) -> DataFrame:
    """Rows of the ``value`` arrays of all pages; a page without ``value`` fails the job.

    Pages are one JSON object per line (splittable), or one per file with ``whole_files``.
    ``ordinal`` adds each row's position (page, place in page).
    """
    page = T.StructType().add("value", T.ArrayType(row)).add(NEXT_LINK, T.StringType())
    pages = spark.read.schema(page).option("mode", "FAILFAST").json(path, multiLine=whole_files)
    present = F.coalesce(F.col("value"), F.raise_error(F.lit("page without a 'value' array")).cast(T.ArrayType(row)))
    if not ordinal:
        return pages.select(F.inline(present))
    placed = pages.select(file_ordinal().alias("_page"), F.posexplode(present).alias("_place", "_row"))
    return placed.select("_row.*", F.struct("_page", "_place").alias(ORDINAL))


def read_xml_catalogue(spark: SparkSession, path, row_tag: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per ``row_tag`` element, one string column per child tag, namespaces ignored."""
    reader = spark.read.format("xml").option("rowTag", row_tag).option("ignoreNamespace", "true")
    reader = reader.option("inferSchema", "false").option("mode", "FAILFAST")
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.load(path)


def pick_dataset(
    catalogue: DataFrame, phrases: Sequence[str], preferred: str, order: Column | str, location: str | None = None
) -> DataFrame:
    """The one catalogue row to use: contains a phrase, preferably matches a pattern, else the first.

    A top-1, so only one row per task travels. ``location`` adds the check that the chosen row
    says where its file is.
    """
    if location is not None:
        require_columns(catalogue, [location])
    text = F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in catalogue.columns])
    first = F.col(order) if isinstance(order, str) else order
    picked = (
        catalogue.withColumn("_text", text)
        .where(S.contains_any(F.col("_text"), phrases))
        .orderBy(F.desc(F.col("_text").rlike(f"(?i){preferred}")), first.asc())
        .limit(1)
        .drop("_text")
    )
    if location is None:
        return picked
    found = F.when(F.length(F.trim(F.col(location))) > 0, F.col(location))
    stop = F.raise_error(F.lit(f"the chosen catalogue row has no {location}")).cast("string")
    return picked.withColumn(location, F.coalesce(found, stop))


def dataset_location(picked: DataFrame, location: str) -> str:
    row = picked.select(location).first()
    if row is None:
        raise ContractError("no catalogue row matches")
    return row[0]


def resolve_aliases(available: Sequence[str], candidates: Mapping[str, Sequence[str]]) -> dict[str, str]:
    """``{target: actual column}``: the first candidate present, ignoring case and outer blanks."""
    by_text = {c.strip().lower(): c for c in available}
    found = {}
    for target, names in candidates.items():
        hits = [by_text[n.strip().lower()] for n in names if n.strip().lower() in by_text]
        if not hits:
            raise ContractError(f"none of the columns {list(names)} found; available columns {list(available)}")
        found[target] = hits[0]
    return found


def read_long_csv(
    spark: SparkSession, path, candidates: Mapping[str, Sequence[str]], ordinal: bool = False
) -> DataFrame:
    """Long bulk table as text columns under target names; the parser skips all other columns."""
    text = spark.read.option("header", "true").option("nullValue", "").csv(path)
    found = resolve_aliases(text.columns, candidates)
    position = [file_ordinal().alias(ORDINAL)] if ordinal else []
    return text.select(*[F.col(f"`{source}`").alias(target) for target, source in found.items()], *position)


def read_csv_table(spark: SparkSession, path, schema: T.StructType, ordinal: bool = False) -> DataFrame:
    """CSV with a declared schema: missing file and missing columns are named errors.

    The header decides the column order, so files may carry more columns or another order;
    values that do not fit the declared type become NULL.
    """
    try:
        text = spark.read.option("header", "true").option("nullValue", "").csv(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"{path} does not exist; run the step that lands it first") from e
        raise
    require_columns(text, schema.names)
    position = [file_ordinal().alias(ORDINAL)] if ordinal else []
    return text.select(*[_typed(f).alias(f.name) for f in schema.fields], *position)


def _typed(field: T.StructField) -> Column:
    text = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return text
    number = S.text_to_number(text)
    if isinstance(field.dataType, T.DoubleType):
        return number
    if isinstance(field.dataType, (T.IntegerType, T.LongType)):
        return number.try_cast(field.dataType)
    return text.try_cast(field.dataType)
