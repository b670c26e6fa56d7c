"""Stored tables: reading, optional inputs, fallback, full refresh, exports and model bundles."""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneloom.operators.models import Model, load_model, save_model
from paneloom.operators.quality import ContractError, require_columns, require_unique_key

READ_OPTIONS = {"csv": {"header": "true", "nullValue": ""}}
WRITE_OPTIONS = {
    "csv": {
        "header": "true", "nullValue": "", "emptyValue": "",
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",  # the writer would cut blanks
    }
}


def read(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.format(fmt).options(**READ_OPTIONS.get(fmt, {}))
    return (reader if schema is None else reader.schema(schema)).load(path)


def read_if_present(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None):
    """The table, or None when nothing is stored there."""
    try:
        return read(spark, path, fmt, schema)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def load_with_fallback(
    spark: SparkSession,
    exports: Mapping[str, str],
    views: Mapping[str, Callable[[], DataFrame]],
    optional: Mapping[str, tuple[str, T.StructType]] | None = None,
    fmt: str = "parquet",
    schemas: Mapping[str, T.StructType] | None = None,
) -> dict[str, DataFrame]:
    """All exports if every one is there, otherwise all views; absent optional tables are empty."""
    stored = {n: read_if_present(spark, p, fmt, (schemas or {}).get(n)) for n, p in exports.items()}
    complete = all(df is not None for df in stored.values())
    loaded = stored if complete else {n: view() for n, view in views.items()}
    for name, (path, schema) in (optional or {}).items():
        found = read_if_present(spark, path, fmt, schema)
        loaded[name] = spark.createDataFrame([], schema) if found is None else found
    return loaded


def land(df: DataFrame, path: str, fmt: str = "csv", compression: str | None = None) -> str:
    """Write raw rows with a header; replaces what was there. ``compression`` names a codec: bulk text takes several times the room of its table."""
    options = WRITE_OPTIONS.get(fmt, {}) | ({"compression": compression} if compression else {})
    df.write.mode("overwrite").format(fmt).options(**options).save(path)
    return path


def full_refresh(
    df: DataFrame,
    table: str,
    root: str | None = None,
    key: Sequence[str] = (),
    buckets: int | None = None,
    bucket_by: Sequence[str] = (),
) -> int:
    """Replace a table's content as a whole; readers see the old rows or the new ones.

    The new content is a generation: a folder of its own under ``root`` (the session's warehouse without
    one), written under a staging name and checked there; only then is the table pointed at that folder, one
    catalogue change. A failed load leaves the table as it was, and its own files are deleted. The generation before
    is retained, so that a scan that has started ends with the rows it started with; ``sweep`` deletes it
    later, by the manifest that the table keeps of its generations. Returns the number of
    rows loaded, counted while they were written.

    ``buckets`` and ``bucket_by`` store the rows hashed and sorted, so that facts bucketed
    alike by entity join, and take their lags, without moving again. A table keeps the
    buckets of its first load: they are used again if none are given, and others are refused,
    as are columns of other types. Loads of one table must not run at the same time.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    if exists:
        kept, before = _layout(spark, table)
        if buckets and (buckets, tuple(bucket_by)) != kept:
            raise ContractError(f"{table} has buckets {kept}, not {(buckets, tuple(bucket_by))}")
        buckets, bucket_by = kept
    path = _qualified(spark, f"{(root or spark.conf.get('spark.sql.warehouse.dir')).rstrip('/')}/{table}-{uuid.uuid4().hex}")
    staging = f"{table}_{uuid.uuid4().hex}"
    loaded = Observation()
    writer = df.observe(loaded, F.count(F.lit(1)).alias("rows")).write.format("parquet").option("path", path)
    if buckets:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*(key or bucket_by))
    if exists:  # in the manifest before the first byte: a load that dies is swept as well
        _write_manifest(spark, table, _manifest(spark, table) | {before: None, path: time.time()})
    try:
        writer.saveAsTable(staging)
        if key:
            require_unique_key(spark.table(staging), key)
        if exists:
            _require_types(spark.table(staging), spark.table(table))
            _write_manifest(spark, table, _manifest(spark, table) | {before: time.time(), path: None})
            spark.sql(f"ALTER TABLE {table} SET LOCATION {_quoted(path)}")
            spark.catalog.refreshTable(table)
        else:
            _write_manifest(spark, staging, {path: None})
            spark.sql(f"ALTER TABLE {staging} RENAME TO {table}")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
        _delete(spark, path)
        if exists:
            _write_manifest(spark, table, {p: at for p, at in _manifest(spark, table).items() if p != path} | {before: None})
        raise
    spark.sql(f"DROP TABLE IF EXISTS {staging}")
    return loaded.get["rows"]


#: Property of a table: the folders of its generations, each with the time when it was retired.
MANIFEST = "paneloom.generations"


def generations(spark: SparkSession, table: str) -> dict[str, float | None]:
    """The folders of the table's generations not yet swept: when each was retired (seconds), None for the current one."""
    current = _layout(spark, table)[1]
    return {path: None if path == current else at or 0.0 for path, at in _manifest(spark, table).items()}


def sweep(spark: SparkSession, table: str, older_than: float = 86_400.0) -> list[str]:
    """Delete the generations retired, or begun and never finished, more than ``older_than`` seconds ago.

    That must be longer than any scan or load of the table takes. Folders go before their entries, so a sweep that stops is
    taken up by the next. Returns the folders deleted; the current one never is.
    """
    found = generations(spark, table)
    old = [path for path, at in found.items() if at is not None and at <= time.time() - older_than]
    for path in old:
        _delete(spark, path)
    _write_manifest(spark, table, {path: at for path, at in found.items() if path not in old})
    return old


def _manifest(spark: SparkSession, table: str) -> dict[str, float | None]:
    told = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return json.loads(told.get(MANIFEST, "{}"))


def _write_manifest(spark: SparkSession, table: str, found: Mapping[str, float | None]) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{MANIFEST}' = {_quoted(json.dumps(found))})")


def _quoted(text: str) -> str:
    """``text`` as a string of SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _layout(spark: SparkSession, table: str) -> tuple[tuple[int | None, tuple[str, ...]], str]:
    """The table's buckets (number, columns) and its folder."""
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    columns = tuple(re.findall(r"`([^`]+)`", told.get("Bucket Columns", "")))
    return (int(told["Num Buckets"]) if columns else None, columns), _qualified(spark, told["Location"])


def _require_types(new: DataFrame, old: DataFrame) -> None:
    require_columns(new, old.columns)
    types = dict(new.dtypes)
    changed = [f"{c}: {types[c]} for {kind}" for c, kind in old.dtypes if types[c] != kind]
    if changed or len(new.columns) != len(old.columns):
        raise ContractError(f"columns of the load differ from the table's: {', '.join(changed) or sorted(set(new.columns) - set(old.columns))}")


def _on_store(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, folder: str) -> None:
    path, store = _on_store(spark, folder)
    store.delete(path, True)


def _qualified(spark: SparkSession, folder: str) -> str:
    path, store = _on_store(spark, folder)
    return store.makeQualified(path).toString()


def export_views(views: Mapping[str, DataFrame], folder: str, fmt: str = "csv") -> dict[str, int]:
    """Every view to its own folder; returns rows written per view, counted on the way."""
    written = {}
    for name, df in views.items():
        seen = Observation()
        land(df.observe(seen, F.count(F.lit(1)).alias("rows")), f"{folder}/{name}", fmt)
        written[name] = seen.get["rows"]
    return written


_BUNDLE = T.StructType(
    [
        T.StructField("selected_model_name", T.StringType()),
        T.StructField("feature_columns", T.ArrayType(T.StringType())),
        T.StructField("target_column", T.StringType()),
        T.StructField("horizon", T.IntegerType()),
        T.StructField("purpose", T.StringType()),
        T.StructField("folder", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("saved_at", T.DoubleType()),
    ]
)
_POINTERS = T.StructType([*_BUNDLE.fields, T.StructField("generation", T.IntegerType())])


def save_bundle(
    model: Model | PipelineModel, path: str, name: str | None, features: Sequence[str], target: str, horizon: int, purpose: str
) -> None:
    """A fitted model and the one-row description needed to use it, as a whole or not at all.

    The model goes to a folder of its own; then one file, the description that names the folder, makes it
    the bundle's newest generation. A save that fails before that leaves the bundle as it was.
    """
    spark = SparkSession.active()
    folder = f"model-{uuid.uuid4().hex}"
    kind = save_model(model, f"{path}/{folder}")
    newest = _pointers(spark, path)
    generation = newest[0].generation + 1 if newest else 1
    row = [(name, list(features), target, horizon, purpose, folder, kind, time.time())]
    spark.createDataFrame(row, _BUNDLE).coalesce(1).write.mode("append").parquet(f"{path}/about/generation={generation}")


def _pointers(spark: SparkSession, path: str) -> list:
    """The descriptions of all generations, the newest first."""
    about = read_if_present(spark, f"{path}/about", schema=_POINTERS)
    return [] if about is None else about.orderBy(F.desc("generation"), F.desc("saved_at")).collect()


def load_bundle(spark: SparkSession, path: str, default_name: str = "model") -> tuple[Model | PipelineModel, dict]:
    """The newest complete model and its description; a folder that is no bundle is a named error."""
    if read_if_present(spark, f"{path}/about", schema=_POINTERS) is None:
        raise FileNotFoundError(f"no model bundle at {path}; train a model first")
    found = _pointers(spark, path)
    if not found or not _there(spark, f"{path}/{found[0].folder}"):
        raise ContractError(f"{path} is not a model bundle")
    described = {c: found[0][c] for c in _BUNDLE.names if c not in ("folder", "kind", "saved_at")}
    described["selected_model_name"] = described["selected_model_name"] or default_name
    return load_model(spark, f"{path}/{found[0].folder}", found[0].kind), described


def sweep_bundle(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete all but the newest ``keep`` generations of a bundle; returns how many went."""
    old = _pointers(spark, path)[max(keep, 1) :]
    for row in old:
        _delete(spark, f"{path}/about/generation={row.generation}")
        _delete(spark, f"{path}/{row.folder}")
    return len(old)


def _there(spark: SparkSession, folder: str) -> bool:
    path, store = _on_store(spark, folder)
    return store.exists(path)
