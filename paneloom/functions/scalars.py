"""Scalar column expressions used by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal or scientific notation. Java's own parser would also take "1d" or "0x1p3".
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def text_to_number(text: Column) -> Column:
    """Double, or NULL for anything that is not a number."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(NUMBER_PATTERN), trimmed.try_cast("double"))


def number_or_null(value: Column) -> Column:
    """Double with NaN as NULL."""
    as_double = value.cast("double")
    return F.when(~F.isnan(as_double), as_double)


def number_to_period(number: Column) -> Column:
    """Integer period; a period written as "2010.0" has come through ``text_to_number``."""
    return number.try_cast("int")


def normalise_key(text: Column) -> Column:
    return F.trim(F.upper(text))


def is_alpha3(text: Column) -> Column:
    """Whole-value match of three capital letters (``$`` would also accept a final newline)."""
    return text.rlike(r"\A[A-Z]{3}\z")


def canonical_numeric_code(text: Column, width: int = 3) -> Column:
    """Drop apostrophes, blanks and a float suffix, then zero-fill on the left (never truncate)."""
    bare = F.trim(F.replace(text, F.lit("'"), F.lit("")))
    bare = F.when(bare.endswith(".0"), F.left(bare, F.length(bare) - 2)).otherwise(bare)
    return F.when(F.length(bare) < width, F.lpad(bare, width, "0")).otherwise(bare)


def recode(code: Column, labels: Mapping[str, str]) -> Column:
    """Map known codes to labels and let unknown codes pass through unchanged."""
    branches = None
    for known, label in labels.items():
        branches = (F if branches is None else branches).when(code == known, F.lit(label))
    return code if branches is None else branches.otherwise(code)


def contains_ignoring_case(text: Column, phrase: str) -> Column:
    """Literal, case-insensitive substring test; NULL text does not match."""
    return F.coalesce(F.contains(F.lower(text), F.lit(phrase.lower())), F.lit(False))


def contains_any(text: Column, phrases: Iterable[str]) -> Column:
    test = F.lit(False)
    for phrase in phrases:
        test = test | contains_ignoring_case(text, phrase)
    return test


def clip(value: Column, low: float, high: float) -> Column:
    """Bound a value; NULL stays NULL although ``greatest``/``least`` skip NULLs."""
    return F.when(value.isNotNull(), F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), value)))


def ramp(latest: Column, total_change: Column, step: Column, last: Column, end: Column) -> Column:
    """Linear path from ``latest`` at period ``last`` to ``latest * (1 + total_change)`` at ``end``."""
    progress = clip(F.try_divide((step - last).cast("double"), (end - last).cast("double")), 0.0, 1.0)
    return F.when(end <= last, latest).otherwise(latest * (F.lit(1.0) + total_change * progress))


def parse_flag(value: Column) -> Column:
    """True for the texts true/1 in any case; NULL counts as false."""
    return F.coalesce(F.lower(value.cast("string")).isin("true", "1"), F.lit(False))


def entity_label(name: Column, code: Column) -> Column:
    return F.concat(name, F.lit(" ("), code.cast("string"), F.lit(")"))


def round_half_up(value: Column, digits: int) -> Column:
    return F.round(value, digits)


def round_half_even(value: Column, digits: int) -> Column:
    return F.bround(value, digits)


def thousands(value: Column) -> Column:
    return F.format_number(value, 0)


def percent_text(value: Column, digits: int = 2) -> Column:
    return F.format_string(f"%.{digits}f%%", value)
