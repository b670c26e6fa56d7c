"""Line-first cleaning: rules judge every line, failing lines go, and a document that loses too much goes whole."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneloom.llm import scan

#: The characters counted as symbols, and the phrases of boilerplate lines.
SYMBOLS = "#*$%&|<>"
BOILERPLATE = (
    "all rights reserved", "terms of (service|use)", "privacy policy", "cookie policy", "accept (all )?cookies",
    "uses cookies", "enable javascript", "click here", "subscribe to our", "sign up for", "back to top",
    "skip to (main )?content", "share on (facebook|twitter)", "follow us on",
)
PHRASES = "(?i)(" + "|".join(BOILERPLATE) + ")"


@dataclass(frozen=True)
class Rules:
    """Thresholds of the lines' and of the documents' rules, all in whole numbers.

    A line with a word fails as
      punctuation  with 3 or more symbols, more than one for ``chars_per_symbol`` word characters,
                   or 3 or more exclamation marks, more than one for ``words_per_bang`` words;
      navigation   with 2 or more bars, at least one for ``words_per_bar`` words;
      boilerplate  with one or more of the phrases, at least one for ``words_per_phrase`` words, so that a
                   long line is not lost for a mention; if that is None, with any.
    A document fails beforehand with fewer than ``min_words`` words or with more than
    ``max_repeat_percent`` of its words in repeated 3-word windows, and afterwards if more than
    ``max_lost_percent`` of its word characters were in failed lines.
    """

    chars_per_symbol: int = 10
    words_per_bang: int = 3
    words_per_bar: int = 3
    words_per_phrase: int | None = 20
    min_words: int = 50
    max_repeat_percent: int = 50
    max_lost_percent: int = 30


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_failed_lines", "lost_chars")


def clean_lines(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """Judge and clean every whole text; one output row per input row, repeated rows included.

    Returns ``row`` (a struct of the ``keep`` columns, so no name can clash), ``text`` (without
    the failed lines; null stays null), the MEASURES as bigint, ``base_failed`` and ``kept``.
    A null or empty text has no words and fails for it. Measures are of the text as it came.
    """
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(text).cast("string").alias("text"))
    schema = T.StructType(
        [
            *source.schema.fields,
            *[T.StructField(name, T.LongType()) for name in MEASURES],
            T.StructField("base_failed", T.BooleanType()),
            T.StructField("kept", T.BooleanType()),
        ]
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in scan.slices(batch, 1):
                yield _judged(part, rules)

    return source.mapInArrow(judge, schema)


def _judged(part: pa.RecordBatch, rules: Rules) -> pa.RecordBatch:
    texts = part.column(1)
    data, offsets = scan.buffer(texts)
    hashed = scan.SpanHash(data)
    words = scan.Words(data, offsets, hashed=False)
    words.hashes = hashed(words.starts, words.ends)

    feeds = np.flatnonzero(data == 10)
    line_starts = np.concatenate([[0], feeds[:-1] + 1]).astype(np.int64)
    line_text = np.searchsorted(offsets, line_starts, side="right") - 1
    first_word, last_word = np.searchsorted(words.starts, line_starts), np.searchsorted(words.starts, feeds)
    line_words = last_word - first_word
    in_word = ((data & 0xC0) != 0x80) & ~scan.IS_SPACE[data]
    is_symbol = np.isin(np.arange(256), np.frombuffer(SYMBOLS.encode(), np.uint8))[data]
    count = lambda marks: scan.sum_by(marks, line_starts, feeds)
    chars, symbols, bars, bangs = count(in_word), count(is_symbol), count(data == ord("|")), count(data == ord("!"))

    failed = (symbols >= 3) & (symbols * rules.chars_per_symbol > chars)
    failed |= (bangs >= 3) & (bangs * rules.words_per_bang > line_words)
    failed |= (bars >= 2) & (bars * rules.words_per_bar >= line_words)
    phrases = _phrases(texts, data, line_starts, feeds, line_text)
    failed |= (phrases > 0) & (True if rules.words_per_phrase is None else phrases * rules.words_per_phrase >= line_words)
    failed &= line_words > 0

    n = len(texts)
    per_text = lambda values: np.bincount(line_text, weights=values, minlength=n).astype(np.int64)
    with_word = np.flatnonzero(line_words > 0)
    same = scan.mix(hashed(line_starts[with_word], feeds[with_word]) + scan.mix(line_text[with_word].astype(np.uint64)))
    _, firsts = np.unique(same, return_index=True)
    again = np.ones(len(with_word), bool)
    again[firsts] = False

    out = {
        "n_words": words.counts,
        "word_chars": per_text(chars),
        "n_symbols": per_text(symbols),
        "n_dup_lines": np.bincount(line_text[with_word[again]], minlength=n),
        "n_repeat_words": _repeat_words(words, n),
        "n_lines": per_text(line_words > 0),
        "n_failed_lines": per_text(failed),
        "lost_chars": per_text(np.where(failed, chars, 0)),
    }
    base_failed = (out["n_words"] < rules.min_words) | (100 * out["n_repeat_words"] > rules.max_repeat_percent * out["n_words"])
    kept = ~base_failed & (100 * out["lost_chars"] <= rules.max_lost_percent * out["word_chars"])
    return pa.RecordBatch.from_arrays(
        [part.column(0), _without(texts, data, offsets, failed, line_starts, feeds, line_text)]
        + [pa.array(out[name].astype(np.int64)) for name in MEASURES]
        + [pa.array(base_failed), pa.array(kept)],
        names=["row", "text", *MEASURES, "base_failed", "kept"],
    )


def _phrases(texts, data, line_starts, feeds, line_text) -> np.ndarray:
    """How many phrases each line holds; lines are made strings only in texts that hold one somewhere."""
    hit = pc.fill_null(pc.match_substring_regex(texts, PHRASES), False).to_numpy(zero_copy_only=False)
    out = np.zeros(len(line_starts), np.int64)
    look = np.flatnonzero(hit[line_text])
    if len(look):
        lines = pa.array([data[a:b].tobytes() for a, b in zip(line_starts[look], feeds[look], strict=True)], pa.binary())
        out[look] = pc.count_substring_regex(lines.cast(pa.string()), PHRASES).to_numpy(zero_copy_only=False)
    return out


def _repeat_words(words: scan.Words, n: int) -> np.ndarray:
    """Words per text that lie in a 3-word window found twice or more in that text."""
    hashes, text, first = scan.windows(words, 3)
    full = words.counts[text] >= 3
    hashes, text, first = scan.mix(hashes[full] + scan.mix(text[full].astype(np.uint64))), text[full], first[full]
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    equal = ordered[1:] == ordered[:-1]
    twice = np.zeros(len(ordered), bool)
    twice[1:] |= equal
    twice[:-1] |= equal
    start = first[order[twice]]
    covered = np.zeros(len(words.starts) + 2, bool)
    for j in range(3):
        covered[start + j] = True
    return np.bincount(words.text[covered[: len(words.starts)]], minlength=n)


def _without(texts, data, offsets, failed, line_starts, feeds, line_text) -> pa.Array:
    """The texts without their failed lines; texts without such a line as they are."""
    touched = np.unique(line_text[failed])
    if not len(touched):
        return texts
    firsts = np.searchsorted(line_text, touched)
    ends = np.searchsorted(line_text, touched, side="right")
    out = texts.to_pylist()
    for i, a, b in zip(touched.tolist(), firsts.tolist(), ends.tolist(), strict=True):
        out[i] = b"\n".join(data[line_starts[k] : feeds[k]].tobytes() for k in range(a, b) if not failed[k]).decode()
    return pa.array(out, texts.type)


def kept_documents(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The columns of ``docs`` with cleaned texts, rejected documents gone; ``n_chars`` follows the text."""
    others = [c for c in docs.columns if c != "text"]
    judged = clean_lines(docs, others, rules=rules).where("kept")
    fresh = {"text": F.col("text"), "n_chars": F.char_length("text").cast("bigint")}
    return judged.select(*[fresh.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
