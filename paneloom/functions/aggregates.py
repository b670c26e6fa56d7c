"""Aggregate expressions that are safe on singletons, constant columns and NULLs.

All of them have partial (map-side) forms, so a group holding a large share of the rows is
reduced on every executor before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nonzero(value: Column) -> Column:
    return F.nullif(value, F.lit(0.0))


def correlation(y: Column, x: Column) -> Column:
    """Pearson correlation; NULL (not an error) when either side has no variance."""
    return F.regr_sxy(y, x) / F.sqrt(nonzero(F.regr_sxx(y, x) * F.regr_syy(y, x)))


def ols_slope(y: Column, x: Column) -> Column:
    return F.regr_sxy(y, x) / nonzero(F.regr_sxx(y, x))


def ols_intercept(y: Column, x: Column) -> Column:
    return F.regr_avgy(y, x) - ols_slope(y, x) * F.regr_avgx(y, x)


def ols_r2(y: Column, x: Column) -> Column:
    explained = F.regr_sxy(y, x) * F.regr_sxy(y, x)
    return explained / nonzero(F.regr_sxx(y, x) * F.regr_syy(y, x))


def ols_count(y: Column, x: Column) -> Column:
    return F.regr_count(y, x)


def mean_absolute_error(actual: Column, predicted: Column) -> Column:
    return F.avg(F.abs(predicted - actual))


def root_mean_squared_error(actual: Column, predicted: Column) -> Column:
    return F.sqrt(F.avg((predicted - actual) * (predicted - actual)))


def r_squared(actual: Column, predicted: Column) -> Column:
    """One pass: 1 - SSE/SST with SST = n * population variance."""
    paired = F.when(predicted.isNotNull(), actual)
    return F.lit(1.0) - F.avg((predicted - actual) * (predicted - actual)) / nonzero(F.var_pop(paired))
