"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A source's target is met with complete epochs first; what remains is selected without
replacement in the order of exponential keys divided by quality weights, until the running
sum of sizes reaches the budget.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneloom.llm.ordering import running_totals
from paneloom.store import materialise

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def quality_weight(text: Column) -> Column:
    """Between 0.05 and 1: falls with the share of symbols in a text; null and empty texts have 0.05."""
    symbols = F.char_length(text) - F.char_length(F.translate(text, "#*$%&|<>", ""))
    return F.greatest(F.lit(0.05), F.coalesce(1 - F.lit(4.0) * symbols / F.nullif(F.char_length(text), F.lit(0)), F.lit(0.0)))


def exponential_key(identity: Column, weight: Column, seed: int) -> Column:
    """An exponential number of rate ``weight``, the same in every run; the smallest come first."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), identity)), 1, 13), 16, 10).cast("bigint")
    return -F.log((bits.cast("double") + 0.5) / F.lit(2.0**52)) / weight


def source_targets(sizes: DataFrame, cycle: Sequence[float], share: float, most: float) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) per source.

    Sources in code point order, null last, take the weights of ``cycle`` in turn. Together they
    get ``share`` of all sizes; a target stops at ``most`` times its source, and the excess goes to
    the others by weight until none is above: the water level over the ratios cap / weight.
    """
    numbered = sizes.withColumn("no", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), (F.col("no") % len(cycle) + 1).cast("int"))
    weighed = numbered.withColumns({"weight": weight, "cap": F.col("source_size") * F.lit(float(most))})
    ranked = weighed.withColumn("ratio", F.col("cap") / F.col("weight"))
    everything = Window.partitionBy()
    lower = Window.orderBy("ratio", "no").rowsBetween(Window.unboundedPreceding, -1)
    upper = Window.orderBy("ratio", "no").rowsBetween(0, Window.unboundedFollowing)
    budget = F.lit(float(share)) * F.sum("source_size").over(everything)
    level = (budget - F.coalesce(F.sum("cap").over(lower), F.lit(0.0))) / F.sum("weight").over(upper)
    # The level with the k lowest ratios capped rises with k up to the water level, and falls behind it.
    return ranked.withColumn("level", level).withColumn("water", F.max("level").over(everything)).select(
        "source", "source_size", F.coalesce(F.least(F.col("cap"), F.col("water") * F.col("weight")), F.col("cap")).alias("target")
    )


def mix_sources(
    docs: DataFrame,
    source: str = "source",
    identity: str = "doc_id",
    text: str = "text",
    cycle: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 0,
) -> DataFrame:
    """(row, size, source_size, target, copies, taken): how often the mix takes every document.

    ``row`` is a struct of all input columns. Sizes are words; a document without words has size
    0 and comes with the complete epochs only. A document at the border of the last, partial
    epoch is taken if more than half of it lies below the target, so a source's words are within
    half a document of it. Repeated rows are documents of their own; a null source is a source. A key
    comes from identity and text, and equal keys go by size and text: rows that are still equal are
    the same document, so the mix does not depend on how rows arrive. ``taken`` is copies times size. The rows are stored once with their numbers; what is sorted is
    numbers, range-partitioned by (source, key), so one large source is spread over many tasks.
    """
    text_column = F.col(f"row.{text}").cast("string")
    stored = materialise(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("no")), "to-mix")
    content = F.md5(F.coalesce(text_column, F.lit("")))
    named = F.concat(F.coalesce(F.col(f"row.{identity}").cast("string"), F.lit("null")), F.lit(":"), content)
    sized = materialise(
        stored.select(
            "no",
            F.col(f"row.{source}").cast("string").alias("source"),
            word_count(text_column).alias("size"),
            exponential_key(named, quality_weight(text_column), seed).alias("key"),
            content.alias("content"),
        ),
        "sizes",
    )
    targets = materialise(
        source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), cycle, share, most), "targets"
    )
    ordered = running_totals(sized, ["source"], ["key", "size", "content", "no"], "size")
    of = targets.withColumnRenamed("source", "of")
    epochs = F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0)).cast("bigint")
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    partial = (F.col("size") > 0) & (F.col("before") + F.col("size") / 2 <= rest)
    decided = (
        ordered.join(of, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("epochs", epochs)
        .withColumn("copies", F.col("epochs") + partial.cast("bigint"))
        .select(F.col("no").alias("numbered"), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )
    return stored.join(decided, F.col("no") == F.col("numbered")).drop("no", "numbered")


def mixed_documents(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The columns of ``docs``, every row as often as the mix takes it."""
    mixed = mix_sources(docs, seed=seed).withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    return mixed.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
