"""Cleaning: projection, coercion, filters, dedup, code lookup and long-to-wide pivot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneloom.functions import scalars as S


def project_rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep the columns in ``names`` (source -> target) under their target names."""
    return df.select(*[F.col(source).alias(target) for source, target in names.items()])


def recode_passthrough(df: DataFrame, code: str, target: str, labels: Mapping[str, str]) -> DataFrame:
    return df.withColumn(target, S.recode(F.col(code), labels))


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Doubles; text that is no number becomes NULL. Numeric columns are only cast."""
    types = dict(df.dtypes)
    return df.withColumns(
        {
            c: S.text_to_number(F.col(c)) if types[c] == "string" else S.number_or_null(F.col(c))
            for c in columns
        }
    )


def coerce_known_numeric(df: DataFrame, known: Sequence[str]) -> DataFrame:
    """Coerce whichever of the known columns are present."""
    return coerce_numeric(df, [c for c in known if c in df.columns])


def periods_to_int(df: DataFrame, period: str) -> DataFrame:
    return df.withColumn(period, S.number_to_period(F.col(period)))


def normalise_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: S.normalise_key(F.col(c)) for c in columns})


def keep_alpha3(df: DataFrame, column: str) -> DataFrame:
    return df.where(S.is_alpha3(F.col(column)))


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with NULL (or NaN in a floating column) in any of ``columns``.

    ``DataFrame.dropna`` treats NaN as missing for float and double columns, too.
    """
    return df.dropna(how="any", subset=list(columns))


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``order``, then by the other columns.

    A row number of one is a group limit that Spark also applies before the shuffle, so every
    task sends one row per key, and a key that owns a third of the table is no task's burden.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    number = F.row_number().over(Window.partitionBy(*key).orderBy(*order, *rest))
    return df.withColumn("_number", number).where("_number = 1").drop("_number")


def lookup_codes(
    df: DataFrame, raw_code: str, dimension: DataFrame, code: str, entity: str, target: str, width: int = 3
) -> DataFrame:
    """Numeric area code -> entity code through a dimension table; unknown codes give NULL.

    The dimension goes in unhinted: Spark broadcasts it when its measured size allows and
    shuffles (splitting skewed codes) when it does not.
    """
    codes = dimension.select(
        S.canonical_numeric_code(F.col(code).cast("string"), width).alias("_code"),
        F.col(entity).alias(target),
    )
    keyed = df.withColumn("_code", S.canonical_numeric_code(F.col(raw_code), width))
    return keyed.join(codes, "_code", "left").drop("_code")


def keep_items(df: DataFrame, item: str, phrase: str, element: str, elements: Sequence[str]) -> DataFrame:
    """Item contains the phrase (any case) and element is exactly one of ``elements``."""
    return df.where(F.col(element).isin(list(elements)) & S.contains_ignoring_case(F.col(item), phrase))


def ensure_columns(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Exactly the expected columns in order; absent ones are added as NULL."""
    return df.select(
        *[
            F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in expected.fields
        ]
    )


def pivot_first(
    df: DataFrame, key: Sequence[str], element: str, value: str, order: Column, targets: Mapping[str, str]
) -> DataFrame:
    """Long to wide, each cell the first non-NULL value by ``order``.

    The elements are listed, so there is no job to discover them, and the conditional
    ``min_by`` combines map-side. With a struct as ``order`` it is a sort aggregate; picking the
    firsts by row number and pivoting them in a hash aggregate measured no faster, and shuffles
    twice. Keys without any value vanish.
    """
    cells = [
        F.min_by(F.col(value), F.when((F.col(element) == e) & F.col(value).isNotNull(), order)).alias(t)
        for e, t in targets.items()
    ]
    wanted = df.where(F.col(element).isin(list(targets)) & F.col(value).isNotNull())
    return wanted.groupBy(*key).agg(*cells)


def category_slice(df: DataFrame, category: str, aggregate: str, drop: Sequence[str]) -> DataFrame:
    """Rows of the aggregate category without the category columns."""
    return df.where(F.col(category) == aggregate).drop(*drop)


def at_point(df: DataFrame, **values) -> DataFrame:
    """Conjunction of equalities, pushed down to the scan."""
    for column, value in values.items():
        df = df.where(F.col(column) == F.lit(value))
    return df


def keep_groups(df: DataFrame, group: str, wanted: Sequence[str]) -> DataFrame:
    return df.where(F.col(group).isin(list(wanted)))


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows usable for training: every listed column present."""
    return drop_missing(df, columns)


def sorted_for_sink(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Range-partitioned global order: each output file holds one sorted key range."""
    return df.orderBy(*key)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    first, *others = frames
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def options(df: DataFrame, entity: str, name: str) -> DataFrame:
    """Distinct (entity, name) pairs by name, with their display label."""
    return (
        df.select(entity, name)
        .distinct()
        .withColumn("label", S.entity_label(F.col(name), F.col(entity)))
        .orderBy(name, entity)
    )
