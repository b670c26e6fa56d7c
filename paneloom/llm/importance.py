"""Importance resampling towards a target text distribution, on hashed n-grams.

A 256-byte table puts UTF-8 text into lower case and blanks all separators, ``bytes.split`` gives the
words, and ``zlib.crc32`` seeded with the hash of a shorter run extends it by a word. Counters reduce
the corpus and the target to counts per bucket; a document's weight is the sum of its features' log
ratios, and the highest weights plus Gumbel noise are a draw without replacement.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneloom.llm import scan
from paneloom.llm.ordering import running_totals
from paneloom.store import materialise

#: A-Z in lower case; a-z, 0-9 and all bytes of other letters as they are; the rest a space.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Bytes of a text split at once, and distinct words that a task holds at once.
PIECE = 1 << 20
HELD = 1 << 18


@dataclass(frozen=True)
class Features:
    """Runs of 1 to ``width`` consecutive words, hashed into ``buckets``."""

    width: int = 2
    buckets: int = 10_000


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists of bounded size."""
    plain, at = text.translate(TABLE), 0
    while at < len(plain):
        end = plain.find(b" ", at + PIECE)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def longer_runs(text: bytes, width: int) -> Iterator[list[int]]:
    """The hashes of all runs of 2 to ``width`` words, each run's hash seeded with that of the run before its last word."""
    tail: list[bytes] = []
    for words in pieces(text):
        joined = tail + words
        hashes = [crc32(w) for w in joined]
        for k in range(2, width + 1):
            hashes = [crc32(b" " + joined[i + k - 1], hashes[i]) for i in range(len(joined) - k + 1)]
            yield hashes[max(0, len(tail) - k + 1) :]  # the earlier ones end in words seen before
        tail = joined[len(joined) - min(len(joined), width - 1) :]


def _texts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        for part in scan.slices(batch, column):
            yield part, [v.as_buffer().to_pybytes() if v.is_valid else b"" for v in part.column(column).cast(pa.large_binary())]


def bucket_counts(docs: DataFrame, features: Features, text: str = "text") -> DataFrame:
    """(bucket, n): features of all texts by bucket; at most ``buckets`` rows leave a task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(features.buckets, np.int64)
        words: Counter[bytes] = Counter()

        def fold() -> None:
            for word, n in words.items():
                total[crc32(word) % features.buckets] += n
            words.clear()

        for _, texts in _texts(batches, 0):
            for value in texts:
                for found in pieces(value):
                    words.update(found)
                    if len(words) > HELD:
                        fold()
                if features.width > 1:
                    for hashes in longer_runs(value, features.width):
                        for bucket, n in Counter(h % features.buckets for h in hashes).items():
                            total[bucket] += n
        fold()
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["bucket", "n"])

    counted = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, features: Features, text: str = "text", target_text: str = "text") -> list[int]:
    """floor(1000 * log ratio) of every bucket's smoothed share in the target and in the corpus.

    The counts reach the driver: two numbers a bucket, at any size of the tables.
    """
    mine, theirs = np.zeros(features.buckets, np.int64), np.zeros(features.buckets, np.int64)
    for counts, frame, column in ((mine, docs, text), (theirs, target, target_text)):
        for row in bucket_counts(frame, features, column).collect():
            counts[row.bucket] = row.n
    s_all, t_all = int(mine.sum()), int(theirs.sum())
    ratio = lambda s, t: float(t + 1) * float(s_all + features.buckets) / (float(s + 1) * float(t_all + features.buckets))
    return [math.floor(1000 * math.log(ratio(s, t))) for s, t in zip(mine.tolist(), theirs.tolist(), strict=True)]


class _Gains(dict):
    """The gain of a word, looked up by hash once and then kept, for a bounded number of words."""

    def __init__(self, by_bucket: list[int]) -> None:
        super().__init__()
        self.by_bucket = by_bucket

    def __missing__(self, word: bytes) -> int:
        if len(self) > HELD:
            self.clear()
        gain = self[word] = self.by_bucket[crc32(word) % len(self.by_bucket)]
        return gain


def weigh(docs: DataFrame, gains: list[int], features: Features, keep: Sequence[str], text: str = "text") -> DataFrame:
    """(row, identity of the text, n_words, n_features, weight); ``row`` is a struct of the ``keep`` columns."""
    content = F.col(text).cast("string")
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.xxhash64(content).alias("content"), content.alias("text"))
    numbers = ["n_words", "n_features", "weight"]
    schema = T.StructType([*source.schema.fields[:2], *[T.StructField(n, T.LongType()) for n in numbers]])
    buckets = features.buckets

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain_of = _Gains(gains)
        for part, texts in _texts(batches, 2):
            out = []
            for value in texts:
                n_words = n_features = weight = 0
                for words in pieces(value):
                    n_words += len(words)
                    weight += sum(map(gain_of.__getitem__, words))
                if features.width > 1:
                    for hashes in longer_runs(value, features.width):
                        n_features += len(hashes)
                        weight += sum(gains[h % buckets] for h in hashes)
                out.append((n_words, n_words + n_features, weight))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), *[pa.array(c, pa.int64()) for c in zip(*out, strict=True)]], names=["row", "content", *numbers]
            )

    return source.mapInArrow(weighed, schema)


def gumbel(identity: Column, seed: int) -> Column:
    """floor(1000 * g) for a Gumbel number g drawn by the hash of seed and identity; a null counts as the text 'null'."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(identity.cast("string"), F.lit("null"))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint").cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


def importance_sample(
    docs: DataFrame,
    target: DataFrame,
    keep: Sequence[str] = ("doc_id",),
    identity: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    features: Features = Features(),
    percent: int = 10,
    least_words: int = 20,
    seed: int = 2024,
) -> DataFrame:
    """Every row's (row, n_words, n_features, weight, score, rank): rank is null for rows not drawn.

    Of the N rows with ``least_words`` words, the floor(percent * N / 100) with the highest scores are
    drawn, ties to the smaller identity, null last. A null text has no words; rows without features
    weigh 0. Repeated rows are rows of their own: they share a score, and rows equal in identity and text take
    their ranks in any order. An empty corpus gives no rows, an empty target weighs by the corpus alone.
    Scores are range-partitioned, so the draw and its order are never in one task.
    """
    gains = bucket_gains(docs, target, features, text, target_text)
    weighed = weigh(docs, gains, features, [*dict.fromkeys([*keep, identity])], text)
    drawn_by = F.col("row").getField(identity)
    scored = materialise(
        weighed.select(
            "*", (F.col("weight") + gumbel(drawn_by, seed)).alias("score"), F.monotonically_increasing_id().alias("no"),
        ),
        "scored",
    )
    able = scored.where(F.col("n_words") >= least_words)
    draw = able.count() * percent // 100
    order = able.select((-F.col("score")).alias("worse"), drawn_by.isNull().alias("nameless"), drawn_by.alias("name"), "content", "no", F.lit(1).alias("one"))
    placed = running_totals(order, [], ["worse", "nameless", "name", "content", "no"], "one")
    drawn = placed.where(F.col("before") < draw).select(F.col("no").alias("drawn"), (F.col("before") + 1).alias("rank"))
    kept = F.struct(*[F.col("row").getField(c).alias(c) for c in keep]).alias("row")
    return scored.join(drawn, F.col("no") == F.col("drawn"), "left").select(kept, "n_words", "n_features", "weight", "score", "rank")


def resample(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The drawn rows with the columns of ``docs``."""
    drawn = importance_sample(docs, target, keep=docs.columns, **settings).where(F.col("rank").isNotNull())
    return drawn.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
