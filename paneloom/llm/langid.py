"""Language identification by the nearest of several centroids per language.

Texts become TF-IDF vectors of hashed byte trigrams of unit length. Every language's sample is
clustered by spherical k-means; a text takes the language of the centroid with the highest
cosine, and is rejected if its distance (1 - cosine) lies outside that centroid's radius. As a
short text lies far from any centroid, a centroid has a radius for each size of text (SIZES).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneloom.llm import scan
from paneloom.store import materialise

UNKNOWN = "und"
DIMENSIONS = 1 << 13
BLOCK = 64
#: Sizes of texts, as powers of two of their distinct trigrams; bytes that texts are cut to for measuring the small sizes.
SIZES = 14
CUTS = (4, 8, 16, 32, 64, 128, 256, 512, 1024, 2048)
#: A centroid's own distances of a size are used from so many on, those of its language otherwise.
OWN = 30

#: Letters of ASCII in lower case, bytes of other letters as they are, all else a space.
LETTERS = np.full(256, 32, dtype=np.uint8)
LETTERS[97:123] = np.arange(97, 123)
LETTERS[65:91] = np.arange(97, 123)
LETTERS[128:] = np.arange(128, 256)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]  # of each centroid
    centroids: np.ndarray  # unit rows
    radius: np.ndarray  # centroids x SIZES
    idf: np.ndarray


def _counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Trigram counts per text (texts x DIMENSIONS), for a block of texts."""
    letters = LETTERS[data].astype(np.uint32)
    n = len(offsets) - 1
    if len(letters) < 3:
        return np.zeros((n, DIMENSIONS), np.float32)
    code = (letters[:-2] << np.uint32(16)) | (letters[1:-1] << np.uint32(8)) | letters[2:]
    text = np.repeat(np.arange(n), np.diff(offsets))[: len(code)]
    inside = (np.arange(2, len(letters)) < offsets[text + 1]) & (code != 0x202020)
    where = ((code * np.uint32(2654435761)) >> np.uint32(19)).astype(np.int64) + text * DIMENSIONS
    return np.bincount(where[inside], minlength=n * DIMENSIONS).reshape(n, DIMENSIONS).astype(np.float32)


def _blocks(texts: pa.Array) -> Iterator[np.ndarray]:
    data, offsets = scan.buffer(texts)
    for start in range(0, len(texts), BLOCK):
        edge = offsets[start : start + BLOCK + 1]
        yield _counts(data[edge[0] : edge[-1]], edge - edge[0])


def _vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weighted = np.log1p(counts) * idf
    length = np.sqrt(np.einsum("ij,ij->i", weighted, weighted))
    return weighted / np.maximum(length, 1e-12)[:, None]


def _sizes(counts: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum((counts > 0).sum(1), 1)).astype(np.int64)


def _clusters(vectors: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Spherical k-means; every start but the first is the mean of the farthest quarter, so no single outlier makes one."""
    chosen = [vectors[int(np.argmax(vectors @ vectors.mean(0)))]]
    near = vectors @ chosen[0]
    for _ in range(1, min(k, len(vectors))):
        mean = vectors[np.argsort(near, kind="stable")[: max(1, len(vectors) // 4)]].sum(0)
        chosen.append(mean / max(float(np.linalg.norm(mean)), 1e-12))
        near = np.maximum(near, vectors @ chosen[-1])
    centres = np.stack(chosen)
    for _ in range(rounds):
        nearest = np.argmax(vectors @ centres.T, axis=1)
        sums = np.stack([vectors[nearest == j].sum(0) for j in range(len(centres))])
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 0, sums / np.maximum(length, 1e-12), centres)
    return centres


def _least_cosines(texts: list[str], vectors: np.ndarray, centres: np.ndarray, idf: np.ndarray, rounds: int, beyond: float) -> np.ndarray:
    """(centroids x SIZES): the cosine that a share ``beyond`` of the texts of the size fall short of.

    Every text, whole and cut short, is measured by centroids fitted without it, in four parts of the
    sample. A size without texts takes the next smaller one's cosine, 0 if there is none.
    """
    part = np.arange(len(texts)) % 4
    held = {p: _clusters(vectors[part != p], len(centres), rounds) for p in set(part.tolist()) if (part != p).any()}
    own = np.argmax(vectors @ centres.T, axis=1)
    raw = [t.encode() for t in texts]
    of, size, cosine = [], [], []
    for cut in (*CUTS, None):
        for p, others in held.items():
            rows = [i for i in np.flatnonzero(part == p).tolist() if cut is None or len(raw[i]) > cut]
            for start in range(0, len(rows), BLOCK):
                some = rows[start : start + BLOCK]
                data = [raw[i][:cut] + b"\n" for i in some]
                counts = _counts(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
                of.append(own[some])
                size.append(_sizes(counts))
                cosine.append((_vectors(counts, idf) @ others.T).max(1))
    out = np.zeros((len(centres), SIZES))
    if not of:
        return out
    of, size, cosine = np.concatenate(of), np.concatenate(size), np.concatenate(cosine)
    for j in range(len(centres)):
        for k in range(SIZES):
            mine = (size == k) & (of == j)
            mine = mine if mine.sum() >= OWN else size == k
            out[j, k] = np.quantile(cosine[mine], beyond) if mine.any() else out[j, k - 1] if k else 0.0
    return out


def fit_languages(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    order: Column | None = None,
    per_language: int = 400,
    centroids: int = 3,
    rounds: int = 8,
    quantile: float = 0.99,
    slack: float = 0.75,
    most_languages: int = 256,
) -> LanguageModel:
    """Fit on at most ``per_language`` labelled texts of each language, chosen by a hash of ``order`` and text.

    ``per_language`` and ``most_languages`` bound the sample, and with it all that reaches the driver: one vector of
    document frequencies per task and the centroids. Of more languages those with the most texts are learned, the
    first in the alphabet among equals; texts of the others get a learned language or are rejected. Rows without text or
    language are left out, and rows that repeat order, text and language count once. A radius is where
    the cosine is ``slack`` times the one that a share ``quantile`` of the cluster's texts of that size reach by
    centroids fitted without them; a language with one text has nothing to measure by and rejects nothing.
    """
    order = F.lit(0) if order is None else order
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang"), order.alias("pick")).dropna(subset=["text", "lang"])
    # The draws decide without the texts; stored, they are few rows, and the planner leaves the texts where they are.
    drawn = rows.withColumn("draw", F.shiftrightunsigned(F.xxhash64("pick", "text", "lang"), 1))
    different = materialise(drawn.select("lang", "draw").distinct(), "draws")
    learned = different.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most_languages).select("lang")
    first = F.row_number().over(Window.partitionBy("lang").orderBy("draw")) <= per_language
    picked = different.join(learned, "lang", "left_semi").withColumn("first", first).where("first").select(F.col("lang").alias("of"), F.col("draw").alias("at"))
    picked = materialise(picked, "language-draws")
    near = drawn.join(picked, (F.col("lang") == F.col("of")) & (F.col("draw") == F.col("at")))
    sample = materialise(near.groupBy("lang", "draw").agg(F.any_value("text").alias("text")).select("text", "lang"), "languages")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for part in scan.slices(batch, 0):
                for counts in _blocks(part.column(0)):
                    total += (counts > 0).sum(0)
                    seen += len(counts)
        yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([total.tolist()], pa.list_(pa.int64()))], names=["seen", "total"])

    found = sample.select("text").mapInArrow(frequencies, "seen long, total array<long>").collect()
    seen = sum(r.seen for r in found)
    totals = sum((np.array(r.total) for r in found), np.zeros(DIMENSIONS))
    idf = (np.log((1 + seen) / (1 + totals)) + 1).astype(np.float32)

    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("text")  # the parts of the sample do not depend on how rows arrive
        vectors = np.concatenate([_vectors(c, idf) for c in _blocks(pa.array(pdf["text"], pa.string()))])
        centres = _clusters(vectors, centroids, rounds)
        least = _least_cosines(list(pdf["text"]), vectors, centres, idf, rounds, 1 - quantile)
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "centre": [c.tolist() for c in centres], "least": [x.tolist() for x in least]})

    rows = sample.groupBy("lang").applyInPandas(cluster, "lang string, centre array<double>, least array<double>").collect()
    rows.sort(key=lambda r: (r.lang, r.least, r.centre))
    centres = np.array([r.centre for r in rows], np.float32).reshape(len(rows), DIMENSIONS)
    radius = 1 - slack * np.array([r.least for r in rows]).reshape(len(rows), SIZES)
    return LanguageModel(tuple(r.lang for r in rows), centres, radius, idf)


def predict_languages(docs: DataFrame, model: LanguageModel, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """The language of every whole text; one output row per input row.

    Returns ``row`` (a struct of the ``keep`` columns), ``text``, ``lang_pred``, ``score`` (the cosine,
    0 to 1) and ``rejected``. A text that is null or has no letter is ``und``, score 0, rejected;
    so are all texts if the model has no language. Equal cosines take the first language in
    alphabetical order.
    """
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(text).cast("string").alias("text"))
    schema = T.StructType(
        [*source.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    )
    names = np.array([*model.languages, UNKNOWN], dtype=object)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        across = np.ascontiguousarray(model.centroids.T)
        for batch in batches:
            for part in scan.slices(batch, 1):
                texts = part.column(1)
                lettered = pc.fill_null(pc.match_substring_regex(texts, r"\pL"), False).to_numpy(zero_copy_only=False)
                best, score = np.full(len(texts), len(model.languages)), np.zeros(len(texts))
                if len(model.languages):
                    blocks = [(_vectors(c, model.idf) @ across, _sizes(c)) for c in _blocks(texts)]
                    cosines, size = np.concatenate([c for c, _ in blocks]), np.concatenate([k for _, k in blocks])
                    best = cosines.argmax(1)
                    score = np.clip(cosines.max(1), 0, 1).astype(np.float64)
                    rejected = ~lettered | (1 - score > model.radius[best, size])
                    best, score = np.where(lettered, best, len(model.languages)), np.where(lettered, score, 0.0)
                else:
                    rejected = np.ones(len(texts), bool)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), texts, pa.array(names[best], pa.string()), pa.array(score), pa.array(rejected)],
                    names=["row", "text", "lang_pred", "score", "rejected"],
                )

    return source.mapInArrow(predict, schema)


def learnable(doc_id: str = "doc_id") -> Column:
    """The rows that may be learned from; the others are held out. A null id is learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 != 1, F.lit(True))


def accepted_documents(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The columns of ``docs``, ``lang`` as predicted, rejected documents gone."""
    others = [c for c in docs.columns if c != "text"]
    judged = predict_languages(docs, model, others).where("not rejected")
    fresh = {"text": F.col("text"), "lang": F.col("lang_pred")}
    return judged.select(*[fresh.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
