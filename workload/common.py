"""What every registered query shares."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries and their SQL, collected by decorator."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None):
        def register(query: Query) -> Query:
            if name in self.queries:
                raise KeyError(f"query {name} registered twice")
            self.queries[name] = query
            if sql is not None:
                self.sql[name] = sql
            return query

        return register


def six_digits(value: Column) -> Column:
    """Down to a grid of 1e-6 for comparison; both engines do the same floating-point arithmetic.

    The shift is not one half: many results are short decimals that lie exactly between two
    grid points, where a difference in the last bit would decide.
    """
    return F.floor(value * F.lit(1e6) + F.lit(0.4321987)) / F.lit(1e6)


def tidy(df: DataFrame) -> DataFrame:
    """Result types both engines agree on: 64-bit integers, and doubles to six digits."""
    wide = {}
    for name, kind in df.dtypes:
        if kind in ("int", "smallint", "tinyint"):
            wide[name] = F.col(f"`{name}`").cast("bigint")
        elif kind in ("double", "float"):
            wide[name] = six_digits(F.col(f"`{name}`").cast("double"))
    return df.withColumns(wide)
