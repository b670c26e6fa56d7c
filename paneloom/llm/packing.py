"""Packing documents into sequences along a space-filling curve.

Every document's tokens are hashed into a vector, projected to few dimensions and given the
position of that point on a Hilbert curve. Documents in curve order are laid end to end and
cut at every ``length`` tokens, so that a sequence holds neighbours.
"""

from __future__ import annotations

import json
import os
import sys
import types
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneloom.llm import scan
from paneloom.llm.ordering import running_totals
from paneloom.store import materialise

#: Of the curve: dimensions and bits each.
DIMENSIONS = 3
BITS = 12
#: Words whose ids a worker keeps at hand, about 70 MB; then it starts anew.
KEPT_WORDS = 1 << 21
#: Kinds of bytes where texts are cut; letters are those of ASCII and U+00C0 to U+017F.
OTHER, LETTER, SIGN, APOSTROPHE, FEED, SPACE, CONTROL = range(7)
KIND = np.full(256, OTHER, np.uint8)
KIND[:128] = CONTROL
KIND[0x21:0x7F] = SIGN
KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xC3, 0xC4, 0xC5]] = LETTER
KIND[[0x0A, 0x20, 0x27]] = FEED, SPACE, APOSTROPHE
#: Whether a text may be cut between two such bytes, at 8 * the first's kind + the second's.
CUT = np.zeros((8, 8), bool)
CUT[:, SPACE] = True
CUT[LETTER, [SIGN, APOSTROPHE, FEED, CONTROL]] = True
CUT[SIGN, [LETTER, FEED]] = True
CUT[APOSTROPHE, FEED] = True


class WordIds:
    """Token ids of whole texts by a byte-level BPE, every distinct word encoded once.

    The pre-tokeniser of such a vocabulary never joins a word with a following space, so a text
    may be cut before every space and the pieces encoded on their own; where a space stands
    within a run of white space this does not hold, and those texts are encoded as they are.
    With the pattern of the ByteLevel pre-tokeniser, a text is also cut between letters and signs
    (an apostrophe may go with the letters behind it) and around a line feed between two such.
    Known pieces are found by their hashes: sorted keys, and where each one's ids begin and end.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.feed = self._plain(["\n"])[0].tolist()
        rules = json.loads(self.tokenizer.to_str())
        before = rules["pre_tokenizer"] or {}
        plain = rules["normalizer"] is None and not before.get("add_prefix_space", True)
        self.words = plain and before.get("type") == "ByteLevel" and before.get("use_regex", False)
        self.stored = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self._forget()

    @classmethod
    def here(cls, path: str) -> WordIds:
        """This worker's own, which outlives a task."""
        shared = sys.modules.setdefault("_word_ids_of_this_worker", types.ModuleType("_word_ids_of_this_worker"))
        if path not in vars(shared):
            vars(shared)[path] = cls(path)
        return vars(shared)[path]

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.begins = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)
        self.ids = np.zeros(1 << 16, "<u4")
        self.used = 0

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, dtype="<u4") for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An order of the words, their numbers of ids and all ids in it; many words to a call:
        one per line, where the line feed is a token by itself."""
        order, sizes, found = [], [], []
        lines = [i for i, w in enumerate(words) if "\n" not in w] if len(self.feed) == 1 else []
        for k in range(0, len(lines), 1000):
            some = lines[k : k + 1000]
            ids = self._plain(["\n".join([words[i] for i in some]) + "\n"])[0]
            fed = ids == self.feed[0]
            ends = np.flatnonzero(fed)
            if len(ends) == len(some):
                order.append(np.array(some))
                sizes.append(np.diff(ends, prepend=-1) - 1)
                found.append(ids[~fed])
        done = np.zeros(len(words), bool)
        done[np.concatenate([np.zeros(0, np.int64), *order])] = True
        rest = np.flatnonzero(~done)
        plain = self._plain([words[i] for i in rest])
        order.append(rest)
        sizes.append(np.array([len(x) for x in plain], np.int64))
        return np.concatenate(order), np.concatenate(sizes), np.concatenate([np.zeros(0, "<u4"), *found, *plain])

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        if len(self.keys) + len(keys) > KEPT_WORDS:
            self._forget()
        order, sizes, flat = self._encoded(words)
        keys = keys[order]
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), "<u4")])
        self.ids[self.used : self.used + len(flat)] = flat
        begins = self.used + np.cumsum(sizes) - sizes
        self.used += len(flat)
        order = np.argsort(keys)
        where = np.searchsorted(self.keys, keys[order])
        self.keys = np.insert(self.keys, where, keys[order])
        self.begins = np.insert(self.begins, where, begins[order])
        self.sizes = np.insert(self.sizes, where, sizes[order])

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Places of the keys, -1 for unknown ones; looked up in order, as neighbours share what is read."""
        out = np.full(len(keys), -1)
        if len(self.keys):
            order = np.argsort(keys)
            ordered = keys[order]
            at = np.minimum(np.searchsorted(self.keys, ordered), len(self.keys) - 1)
            out[order] = np.where(self.keys[at] == ordered, at, -1)
        return out

    def _cuts(self, data: np.ndarray) -> np.ndarray:
        """Whether a piece begins at the byte, besides those that begin a text."""
        cut = np.zeros(len(data), bool)
        if not self.words:
            cut[1:] = data[1:] == 32
            return cut
        kind = KIND[data]
        lead = np.flatnonzero((data >= 0xC3) & (data <= 0xC5))
        kind[lead + 1] = LETTER
        signs = lead[(data[lead] == 0xC3) & ((data[lead + 1] == 0x97) | (data[lead + 1] == 0xB7))]
        kind[signs] = kind[signs + 1] = OTHER
        cut[1:] = CUT.ravel()[kind[:-1] * 8 + kind[1:]]
        feeds = np.flatnonzero((kind == FEED) & cut)
        feeds = feeds[feeds + 1 < len(data)]
        behind = kind[feeds + 1]
        cut[feeds[(behind >= LETTER) & (behind <= APOSTROPHE)] + 1] = True
        return cut

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and the number of ids of each text."""
        odd = pc.fill_null(pc.match_substring_regex(texts, r"[\s\pZ\x0B\x1C-\x1F\x{85}] ([\s\pZ\x0B\x1C-\x1F\x{85}]|\z)"), False)
        odd = odd.to_numpy(zero_copy_only=False)
        if odd.any():
            return self._mixed(texts, odd)
        data, offsets = scan.buffer(texts)
        cut = self._cuts(data)
        cut[offsets[:-1]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))[: len(starts)]
        firsts = np.searchsorted(starts, offsets)
        ends[firsts[1:] - 1] -= 1  # the line feed behind a text
        some = ends > starts
        text = np.repeat(np.arange(len(texts)), np.diff(firsts))[some]
        starts, ends = starts[some], ends[some]
        at, keys = pd.factorize(scan.SpanHash(data)(starts, ends))
        places = self._find(keys)
        if (places < 0).any():
            new = places < 0
            if len(self.keys) + new.sum() > KEPT_WORDS:
                self._forget()
                new[:] = True
            one = np.zeros(len(keys), np.int64)
            one[at] = np.arange(len(at))
            one, whole = one[new], data.tobytes()
            self._learn(keys[new], [whole[a:b].decode() for a, b in zip(starts[one].tolist(), ends[one].tolist(), strict=True)])
            places = self._find(keys)
        begins, sizes = self.begins[places], self.sizes[places]
        per_piece = sizes[at]
        last = np.cumsum(per_piece)
        where = np.arange(last[-1] if len(last) else 0) + np.repeat(begins[at] - (last - per_piece), per_piece)
        counts = np.bincount(text, weights=per_piece, minlength=len(texts)).astype(np.int64)
        return self.ids[where], counts

    def _mixed(self, texts: pa.Array, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        plain = iter(self._plain(texts.filter(pa.array(odd)).to_pylist()))
        ids, counts = self.encode(texts.filter(pa.array(~odd)))
        split = iter(np.split(ids, np.cumsum(counts)[:-1])) if len(counts) else iter(())
        both = [next(plain) if o else next(split) for o in odd]
        return np.concatenate(both), np.array([len(x) for x in both], np.int64)


def project(ids: np.ndarray, counts: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Points in [0, 1)**dimensions: sums of the ids' random directions, by the size they have for random texts.

    Every id is hashed to one of 2**16 buckets, a bucket has a random sign per dimension; that is a
    hashed bag-of-tokens vector times a random projection, without the vector in between.
    """
    ends = np.cumsum(counts)
    buckets = ids.astype(np.uint16)
    bits = scan.mix(np.arange(1 << 16, dtype=np.uint64) + np.uint64(1))
    out = np.empty((len(counts), dimensions))
    for d in range(dimensions):
        sign = ((bits >> np.uint64(d)) & np.uint64(1)).astype(np.int8) * 2 - 1
        sums = scan.sum_by(sign.astype(np.int8)[buckets], ends - counts, ends)
        out[:, d] = 0.5 + 0.5 * np.tanh(2 * sums / np.maximum(counts, 1))
    return out


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Positions on the Hilbert curve of points in [0, 1]: axes to transposed index, bit by bit."""
    n = points.shape[1]
    x = [np.minimum((points[:, d] * (1 << bits)).astype(np.int64), (1 << bits) - 1) for d in range(n)]
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for d in range(n):
            high = (x[d] & level) != 0
            swap = np.where(high, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[d] = x[d] ^ swap
        level >>= 1
    for d in range(1, n):
        x[d] = x[d] ^ x[d - 1]
    fold = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        fold = np.where((x[n - 1] & level) != 0, fold ^ (level - 1), fold)
        level >>= 1
    position = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(n):
            position = (position << 1) | (((x[d] ^ fold) >> b) & 1)
    return position


def tokenize(docs: DataFrame, vocabulary: str, keep: Sequence[str] = ("doc_id",), text: str = "text", end_id: int = 0) -> DataFrame:
    """(row, no, position, n, ids): ids of every whole text with ``end_id`` behind, little-endian.

    An id takes 16 bits if the vocabulary and ``end_id`` fit, else 32; octet_length(ids) / n tells.

    ``vocabulary`` is the path of a byte-level BPE for the tokenizers library, the same on every
    executor. A null text is empty and has the end id alone. ``position`` is on the curve.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    source = docs.select(row, F.monotonically_increasing_id().alias("no"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([*source.schema.fields[:2], *T._parse_datatype_string("position long, n long, ids binary").fields])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds.here(vocabulary)
        for batch in batches:
            for part in scan.slices(batch, 2):
                ids, counts = words.encode(part.column(2))
                position = hilbert(project(ids, counts))
                ends = np.cumsum(counts)
                kind = np.dtype(words.stored if end_id < 1 << 16 else "<u4")
                ended = np.insert(ids.astype(kind), ends, kind.type(end_id))
                offsets = np.concatenate([[0], np.cumsum(counts + 1) * kind.itemsize]).astype(np.int64)
                blobs = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(ended.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(position), pa.array(counts + 1), blobs.cast(pa.binary())],
                    names=["row", "no", "position", "n", "ids"],
                )

    return source.mapInArrow(encode, schema)


def wide(ids: pa.Array, n: pa.Array) -> pa.Array:
    """Every row's ``n`` ids in 32 bits each; of 16-bit ones, every two bytes get two zero bytes behind them."""
    ids = ids.cast(pa.large_binary())
    _, offsets, data = ids.buffers()
    offsets = np.frombuffer(offsets, np.int64)[ids.offset : ids.offset + len(ids) + 1]
    doubled = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view("<u2").astype("<u4")
    buffers = [None, pa.py_buffer((offsets - offsets[0]) * 2), pa.py_buffer(doubled)]
    narrow = pc.less(pc.binary_length(ids), pc.multiply(n, 4))
    return pc.if_else(narrow, pa.Array.from_buffers(pa.large_binary(), len(ids), buffers), ids).cast(pa.binary())


def pack(tokens: DataFrame, length: int = 1024) -> DataFrame:
    """(row, start, length, ids, doc_tokens, sequence_id, offset): the pieces of all documents.

    Curve order makes one long stream of tokens, cut every ``length`` (a power of two). What is
    left behind the last full sequence is cut into powers of two, the largest first, so nothing
    is padded. ``ids`` are 32-bit here. Every document lies in consecutive pieces; an empty table gives none.
    """
    stored = materialise(tokens, "tokens", "zstd")
    placed = running_totals(stored.select("no", "position", "n"), [], ["position", "no"], "n")
    total = stored.agg(F.sum("n")).first()[0] or 0
    full = total - total % length
    # Starts of the sequences behind the last full one.
    tail, at = [], full
    for bit in range(length.bit_length() - 2, -1, -1):
        if (total - full) >> bit & 1:
            tail.append(at)
            at += 1 << bit
    first_tail = full // length
    tails = F.array(*[F.lit(t).cast("bigint") for t in [*tail, total]])
    begin, end = F.col("before"), F.col("before") + F.col("n")

    def start_of(sequence):
        behind = F.get(tails, (sequence - first_tail).cast("int"))
        return F.when(sequence < first_tail, sequence * length).otherwise(behind)

    def sequence_of(token):
        behind = F.size(F.filter(tails, lambda t: t <= token)) - 1 + F.lit(first_tail)
        return F.when(token < full, F.floor(token / F.lit(length))).otherwise(behind).cast("bigint")

    def piece(sequence):
        low = F.greatest(start_of(sequence), begin)
        high = F.least(start_of(sequence + 1), end)
        return F.struct(
            sequence.alias("sequence_id"), (low - start_of(sequence)).alias("offset"), (low - begin).alias("start"), (high - low).alias("length"),
            F.substring("ids", ((low - begin) * size + 1).cast("int"), ((high - low) * size).cast("int")).alias("ids"),
        )

    size = F.floor(F.octet_length("ids") / F.col("n"))
    where = placed.select(F.col("no").alias("of"), "before")
    pieces = F.transform(F.sequence(sequence_of(begin), sequence_of(end - 1)), piece)
    cut = (
        stored.join(where, F.col("no") == F.col("of"))
        .select("row", F.col("n").alias("doc_tokens"), pieces.alias("pieces"))
        .select("row", "doc_tokens", F.inline("pieces"))
        .select("row", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
    )

    def widened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in scan.slices(batch, 3):
                columns = part.columns
                columns[3] = wide(columns[3], columns[2])
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return cut.mapInArrow(widened, cut.schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): the pieces of every sequence put together; a sequence has ``length`` ids at most."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda all_ids, p: F.concat(all_ids, p["ids"]))
    return pieces.groupBy("sequence_id").agg(joined.alias("ids"))
