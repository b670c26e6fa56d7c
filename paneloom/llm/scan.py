"""Vectorised reading of UTF-8 text inside tasks: one byte buffer per slice of an Arrow batch.

Words and lines are spans of the buffer, their identities 64-bit hashes; no Python string is
made per word. Two different words of the same comparison share a hash with a chance of
about 2**-64, which is taken as never.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
ODD = np.uint64(0xD6E8FEB86659FD93)

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Parts of the batch with about SLICE_BYTES of text each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    for start, end in zip(cuts, cuts[1:], strict=False):
        if end > start:
            yield batch.slice(start, end - start)


def buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes, each text followed by a line feed, and the offsets (one more than texts)."""
    text = lambda x: pa.scalar(x, pa.large_string())
    ended = pc.binary_join_element_wise(pc.fill_null(texts.cast(pa.large_string()), text("")), text(""), text("\n"))
    if isinstance(ended, pa.ChunkedArray):
        ended = ended.combine_chunks()
    _, offsets, data = ended.buffers()
    offsets = np.frombuffer(offsets, np.int64)[ended.offset : ended.offset + len(ended) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class SpanHash:
    """Hashes of spans of one buffer, by prefix sums of a polynomial modulo 2**64."""

    def __init__(self, data: np.ndarray) -> None:
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(BASE, max(len(data), 1))[: len(data)], out=self.sums[1:])
        self.back = _powers(BASE_INVERSE, max(len(data), 1))

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0, np.uint64)
        raw = (self.sums[ends] - self.sums[starts]) * self.back[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * ODD)


class Words:
    """All words ``[^\\x20\\x09-\\x0D]+`` of the texts: spans, the text they belong to, hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, hashed: bool = True) -> None:
        space = IS_SPACE[data]
        before = np.empty_like(space)
        before[:1] = True
        before[1:] = space[:-1]
        self.starts = np.flatnonzero(~space & before)
        self.ends = np.flatnonzero(space & ~before)
        firsts = np.searchsorted(self.starts, offsets)
        self.firsts = firsts[:-1]
        self.counts = np.diff(firsts)
        self.text = np.repeat(np.arange(len(offsets) - 1), self.counts)
        self.hashes = SpanHash(data)(self.starts, self.ends) if hashed else None


def windows(words: Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all word windows: (hash, text, index of the first word).

    A text of fewer words than ``width``, but at least one, has its whole sequence as one window.
    """
    per_text = np.where(words.counts > 0, np.maximum(words.counts - width + 1, 1), 0)
    text = np.repeat(np.arange(len(per_text)), per_text)
    within = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    first = words.firsts[text] + within
    hashes = np.zeros(len(text), np.uint64)
    short = len(text) and bool((words.counts[text] < width).any())
    for j in range(width):
        if short:
            valid = j < words.counts[text]
            at = np.where(valid, first + j, 0)
            hashes = np.where(valid, mix(hashes * ODD + words.hashes[at]), hashes)
        elif len(text):
            hashes = mix(hashes * ODD + words.hashes[first + j])
    return hashes, text, first


def sum_by(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over the spans, empty ones included."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[ends] - sums[starts]
