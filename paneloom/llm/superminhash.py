"""Near-duplicate detection by SuperMinHash signatures, banding, verification and union-find.

A SuperMinHash signature gives every element its own random permutation of the ``rows`` slots: in
step j the element offers j plus a random fraction to the j-th slot of its permutation, and a slot keeps
the least offer. Slots of one set are correlated, which lowers the variance below MinHash's, and a set
whose slots are all taken by step j can stop there, as later offers are larger.

1. Documents become sets of 64-bit shingle hashes with a signature, cut into bands. Equal sets are one class.
2. Classes that share a band lie in one bucket. Every class is verified against the least class that it
   shares a bucket with; the links found join most of every group, in time linear in its size.
3. Buckets that still hold several components make the rest: the classes in them form groups, cut into
   chunks of bounded size in the order of their components. Every pair of chunks with more than one
   component and with sizes that allow links is one task's work: full sets are compared, except where
   earlier links connect them already. No bucket is cut short, and no group is listed pair by pair.
4. All links are joined to components.

Links are confirmed on full sets. A pair at the threshold shares no band with a chance of
(1 - 0.85**6)**32, below 3e-7, for the default bands; similar pairs beyond it far less.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneloom.llm import scan
from paneloom.llm.components import connected_components
from paneloom.llm.ordering import running_totals
from paneloom.store import materialise

#: Shingles in a chunk of a group, about (8 bytes each).
CHUNK = 1 << 17
#: Elements, about, whose permutations are followed at once.
TOGETHER = 1 << 16
#: Shingles, about, that one piece of a star's arms holds.
ARMS = 1 << 21


@dataclass(frozen=True)
class Near:
    """Links need 100 * intersection >= percent * union of word shingles; signatures have bands * per_band slots."""

    width: int = 5
    percent: int = 80
    bands: int = 32
    per_band: int = 6

    def sizes_allow(self, n, m):
        return 100 * np.minimum(n, m) >= self.percent * np.maximum(n, m)

    def linked(self, both, n, m):
        return 100 * both >= self.percent * (n + m - both)


def _sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, by text and hash, and the size of every set."""
    data, offsets = scan.buffer(texts)
    hashes, text, _ = scan.windows(scan.Words(scan.LOWER[data], offsets), width)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return hashes[new], np.bincount(text[new], minlength=len(texts))


def signatures(hashes: np.ndarray, counts: np.ndarray, slots: int) -> np.ndarray:
    """(sets, slots): the SuperMinHash signatures of sets given by their hashes in a row; an empty set's is all ones."""
    ends = np.cumsum(counts)
    block = ends // TOGETHER
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(counts)]
    parts = [_signatures(hashes[ends[a] - counts[a] : ends[b - 1]], counts[a:b], slots) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]
    return np.concatenate(parts) if parts else np.zeros((0, slots), np.uint64)


def _signatures(hashes: np.ndarray, counts: np.ndarray, slots: int) -> np.ndarray:
    """All sets take step j together; those whose slots are all taken have stopped.

    A value is the step in the high half and the fraction in the low half.
    """
    free = np.uint64(2**64 - 1)
    out = np.full((len(counts), slots), free, np.uint64)
    flat = out.reshape(-1)
    owner = np.repeat(np.arange(len(counts)), counts)
    elements, places = hashes, None  # the elements of the sets not yet stopped, and their permutations so far
    for j in range(slots):
        if not len(elements):
            break
        drawn = scan.mix(elements + np.uint64((j + 1) * int(scan.BASE) % 2**64))
        k = j + (((drawn >> np.uint64(32)) * np.uint64(slots - j)) >> np.uint64(32)).astype(np.int64)
        if places is None:
            slot = k
        else:
            at = np.arange(len(elements))
            slot = places[at, k].astype(np.int64)
            places[at, k] = places[:, j]
            places[at, j] = slot
        target = owner * slots + slot
        open_ = flat[target] >= np.uint64(j) << np.uint64(32)  # free, or taken in this very step
        np.minimum.at(flat, target[open_], (np.uint64(j) << np.uint64(32)) | (drawn[open_] & np.uint64(2**32 - 1)))
        going = (out == free).any(1)[owner]
        if places is None:
            elements, owner, k = elements[going], owner[going], k[going]
            places = np.tile(np.arange(slots, dtype=np.uint16 if slots > 256 else np.uint8), (len(elements), 1))
            places[np.arange(len(elements)), k] = 0  # the first exchange, which the first step left out
            places[:, 0] = k
        elif not going.all():
            elements, owner, places = elements[going], owner[going], places[going]
    return out


def band_keys(signature: np.ndarray, bands: int, per_band: int) -> np.ndarray:
    """(sets, bands): a 64-bit key of every band's slots."""
    keys = np.repeat(np.arange(1, bands + 1, dtype=np.uint64)[None, :] * scan.ODD, len(signature), axis=0)
    parts = signature.reshape(len(signature), bands, per_band)
    for i in range(per_band):
        keys = scan.mix(keys * scan.BASE + parts[:, :, i])
    return keys


def _blobs(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64) * 8
    data = pa.py_buffer(np.ascontiguousarray(values, "<u8").tobytes())
    return pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets), data]).cast(pa.binary())


def _slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Slices of bounded text that also hold a bounded number of texts."""
    for part in scan.slices(batch, text):
        for start in range(0, part.num_rows, 2048):
            yield part.slice(start, 2048)


def _summarise(source: DataFrame, near: Near) -> DataFrame:
    """Per row (id, content, text, row): set size, a 128-bit identity of the set, and its band keys instead of the text."""
    added = [T.StructField(name, T.LongType()) for name in ("n", "s1", "s2")] + [T.StructField("keys", T.BinaryType())]
    schema = T.StructType([f for f in source.schema.fields if f.name != "text"] + added)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, 2):
                hashes, counts = _sets(part.column(2), near.width)
                ends = np.cumsum(counts)
                sums = []
                for salt in (1, 2):  # sums do not depend on the order
                    total = np.zeros(len(hashes) + 1, np.uint64)
                    np.cumsum(scan.mix(hashes + np.uint64(salt)), out=total[1:])
                    sums.append(pa.array((total[ends] - total[ends - counts]).view(np.int64)))
                keys = band_keys(signatures(hashes, counts, near.bands * near.per_band), near.bands, near.per_band)
                keyed = np.where(counts > 0, near.bands, 0)
                found = [pa.array(counts.astype(np.int64)), *sums, _blobs(keys[counts > 0].reshape(-1), keyed)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(3), *found], names=schema.names)

    return source.mapInArrow(summarise, schema)


def _postings(classes: DataFrame) -> DataFrame:
    """(key, node, n): one row per band of every class."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                blobs = part.column(2).to_pylist()
                of = pa.array(np.repeat(np.arange(len(blobs)), [len(b) // 8 for b in blobs]))
                keys = np.frombuffer(b"".join(blobs), "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(keys), part.column(0).take(of), part.column(1).take(of)], names=["key", "node", "n"])

    return classes.select("node", "n", "keys").mapInArrow(explode, "key long, node long, n long")


def _buckets(classes: DataFrame) -> DataFrame:
    """(key, node, n, head): the members of all buckets of two or more; the head is the bucket's least node."""
    postings = materialise(_postings(classes), "postings")
    shared = postings.groupBy("key").agg(F.count("*").alias("members"), F.min("node").alias("head")).where("members > 1")
    shared = materialise(shared.select("key", "head"), "heads")  # stored, so that the join can split the rows of a hot bucket
    # The buckets grow with the documents: a sort-merge join at every size; a bucket is one row on its right.
    return postings.join(shared.select(F.col("key").alias("of"), "head").hint("merge"), F.col("key") == F.col("of")).select("key", "node", "n", "head")


def _full_sets(nodes: DataFrame, classes: DataFrame, source: DataFrame, near: Near) -> DataFrame:
    """(node, hashes) of the given nodes, from the texts of their first documents."""
    wanted = classes.join(nodes.hint("merge"), "node", "left_semi").select("node", F.col("first.id").alias("first_id"), F.col("first.content").alias("first_content"))
    found = source.select("id", "content", "text").join(wanted.hint("merge"), F.col("content").eqNullSafe(F.col("first_content")) & F.col("id").eqNullSafe(F.col("first_id")))
    texts = found.groupBy("node").agg(F.any_value("text").alias("text"))  # repeated rows meet map-side

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in scan.slices(batch, 1):
                hashes, counts = _sets(part.column(1), near.width)
                yield pa.RecordBatch.from_arrays([part.column(0), _blobs(hashes, counts)], names=["node", "hashes"])

    return texts.mapInArrow(shingle, "node long, hashes binary")


def _salted(df: DataFrame, by: list[str], size: str, most: int, piece: str) -> DataFrame:
    """Number the pieces of about ``most`` that a group is dealt into, by the group's total."""
    totals = df.groupBy(*by).agg(F.ceil(F.sum(size) / F.lit(most)).cast("int").alias("_pieces")).withColumnsRenamed({c: f"_of_{c}" for c in by})
    match = [F.col(c) == F.col(f"_of_{c}") for c in by]
    return df.join(totals, match).withColumn(piece, F.pmod(F.xxhash64("node"), F.col("_pieces")).cast("int")).drop("_pieces", *[f"_of_{c}" for c in by])


def _stars(buckets: DataFrame, classes: DataFrame, sets: DataFrame, near: Near) -> DataFrame:
    """(a, b): the links between every node and the least head of its buckets; a head's set is read once for each piece of its arms."""
    arms = buckets.groupBy("node").agg(F.min("head").alias("head"), F.first("n").alias("n")).where("node <> head")
    heads = arms.select("head").distinct().join(classes.select(F.col("node").alias("of"), F.col("n").alias("head_n")).hint("merge"), F.col("head") == F.col("of"))
    fits = arms.join(heads.drop("of").hint("merge"), "head").where(
        100 * F.least("n", "head_n") >= near.percent * F.greatest("n", "head_n")
    )
    fits = materialise(fits, "arms")
    dealt = materialise(_salted(fits, ["head"], "n", ARMS, "piece").select("node", "head", "piece"), "dealt")
    roles = dealt.select("head", "piece", "node").unionByName(dealt.select("head", "piece", F.col("head").alias("node")).distinct())
    placed = roles.join(sets.withColumnRenamed("node", "of").hint("merge"), F.col("node") == F.col("of")).select("head", "piece", "node", "hashes")
    pieces = int(buckets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = placed.repartition(pieces, "head", "piece").sortWithinPartitions("head", "piece", (F.col("node") != F.col("head")), "node")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, middle = None, np.zeros(0, np.uint64)
        for batch in batches:
            out = []
            for head, node, blob in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
                values = np.frombuffer(blob.as_buffer(), "<u8")
                if node == head:
                    centre, middle = head, values
                elif head == centre and near.linked(_common(values, middle), len(values), len(middle)):
                    out.append((head, node))
            if out:
                yield _edges(out)

    return placed.mapInArrow(verify, "a long, b long")


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """The number of common values of two sorted arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _rest(buckets: DataFrame, labels: DataFrame, sets: DataFrame, near: Near) -> DataFrame:
    """(a, b): links between components, found among the members of buckets that hold several of them."""
    of = labels.select(F.col("node").alias("of"), F.col("component").alias("label"))
    labelled = materialise(
        buckets.join(of, F.col("node") == F.col("of"), "left").select("key", "node", "n", F.coalesce("label", "node").alias("label")), "labelled"
    )
    mixed = labelled.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least < most")
    members = labelled.join(mixed.select(F.col("key").alias("of"), "least"), F.col("key") == F.col("of"))
    members = materialise(members.groupBy("node", "label", "least").agg(F.first("n").alias("n")), "mixed")
    groups = connected_components(members.select(F.col("label").alias("a"), F.col("least").alias("b")))
    in_group = members.select("node", "label", "n").distinct().join(groups.select(F.col("node").alias("of"), F.col("component").alias("grp")), F.col("label") == F.col("of"))
    chunked = running_totals(in_group.select("grp", "label", "n", "node"), ["grp"], ["label", "n", "node"], "n").select(
        "grp", "label", "n", "node", F.floor(F.col("before") / F.lit(CHUNK)).cast("int").alias("chunk")
    )
    chunked = materialise(chunked, "chunks")
    spans = materialise(
        chunked.groupBy("grp", "chunk").agg(*[f(c).alias(f"{c}_{f.__name__}") for c in ("n", "label") for f in (F.min, F.max)]), "spans"
    )
    other = spans.withColumnsRenamed({c: f"{c}_2" for c in spans.columns})
    same = (F.col("label_min") == F.col("label_max")) & (F.col("label_min_2") == F.col("label_max_2")) & (F.col("label_min") == F.col("label_min_2"))
    sized = lambda a, b: 100 * F.col(a) >= near.percent * F.col(b)
    cells = spans.join(
        other, (F.col("grp") == F.col("grp_2")) & (F.col("chunk") <= F.col("chunk_2")) & ~same & sized("n_max", "n_min_2") & sized("n_max_2", "n_min")
    ).select("grp", F.col("chunk").alias("i"), F.col("chunk_2").alias("j"))
    cells = materialise(cells, "cells")
    by_chunk = cells.select(F.col("grp").alias("g"), "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("k"))
    whole = chunked.join(sets.withColumnRenamed("node", "of").hint("merge"), F.col("node") == F.col("of")).drop("of")
    placed = whole.join(by_chunk, (F.col("grp") == F.col("g")) & (F.col("chunk") == F.col("k"))).select("g", "i", "j", "chunk", "label", "node", "hashes")
    pieces = int(buckets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = placed.repartition(pieces, "g", "i", "j").sortWithinPartitions("g", "i", "j", "chunk", "label", "node")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, i, j), rows in _cells(batches):
            out = list(search(rows, near, i == j))
            if out:
                yield _edges(out)

    return dealt.mapInArrow(find, "a long, b long")


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list]]:
    """The rows (chunk, label, hashes) of each cell; its chunks bound what is held."""
    cell, rows = None, []
    for batch in batches:
        for g, i, j, chunk, label, _, blob in zip(*[column.to_pylist() for column in batch.columns], strict=True):
            if (g, i, j) != cell:
                if len(rows) > 1:
                    yield cell, rows
                cell, rows = (g, i, j), []
            rows.append((chunk, label, np.frombuffer(blob, "<u8")))
    if len(rows) > 1:
        yield cell, rows


def search(rows: list[tuple[int, int, np.ndarray]], near: Near, alone: bool) -> Iterator[tuple[int, int]]:
    """Pairs of components that sets of a cell link, by full sets; ``alone``: all rows among themselves, not chunk against chunk."""
    chunk = np.array([r[0] for r in rows])
    names, component = np.unique(np.array([r[1] for r in rows], np.int64), return_inverse=True)
    sizes = np.array([len(r[2]) for r in rows], np.int64)
    parent = np.arange(len(names))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return int(i)

    # The smaller side asks the larger one.
    first = chunk == chunk[0]
    asking = np.ones(len(rows), bool) if alone else first if 2 * first.sum() <= len(rows) else ~first
    asked = np.ones(len(rows), bool) if alone else ~asking
    answering = np.flatnonzero(asked)
    owner = np.repeat(answering, sizes[answering])
    flat = np.concatenate([rows[y][2] for y in answering])
    order = np.argsort(flat, kind="stable")
    ordered, owner = flat[order], owner[order]
    roots = np.arange(len(names))
    for x in np.flatnonzero(asking):
        others = asked & (roots[component] != roots[component[x]]) & near.sizes_allow(sizes, sizes[x])
        if alone:
            others[:x] = False
        if not others.any():
            continue
        begins, ends = np.searchsorted(ordered, rows[x][2]), np.searchsorted(ordered, rows[x][2], side="right")
        lengths = ends - begins
        at = np.repeat(begins - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        both = np.bincount(owner[at], minlength=len(rows))
        for y in np.flatnonzero(others & near.linked(both, sizes, sizes[x])):
            a, b = root(component[x]), root(component[y])
            if a != b:
                parent[max(a, b)] = min(a, b)
                yield int(names[component[x]]), int(names[component[y]])
        roots = _roots(parent)


def _roots(parent: np.ndarray) -> np.ndarray:
    up = parent
    while True:
        above = up[up]
        if (above == up).all():
            return up
        up = above


def near_duplicates(docs: DataFrame, near: Near = Near(), doc_id: str = "doc_id", text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """(row, id, n_shingles, component_id, kept) for every row; ``row`` is a struct of the ``keep`` columns, null without any.

    A set is the distinct shingles of ``width`` words, A-Z in lower case; a text of fewer words has its whole
    sequence as one. A text that is null or without words has none, links with nothing and is kept.
    ``component_id`` is the smallest id reachable by links, null only if no row there has an id: rows without an id
    take part like all others. ``kept`` marks one row of each component: the first by id (null last) and text.
    """
    row = (F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.lit(None).cast("boolean")).alias("row")
    body = F.col(text).cast("string")
    source = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.xxhash64(body).alias("content"), body.alias("text"), row)
    sets = materialise(_summarise(source, near).withColumn("no", F.monotonically_increasing_id()), "sets")
    first = F.struct(F.col("id").isNull().alias("nameless"), "id", "content", "no")
    classes = sets.where("n > 0").groupBy("n", "s1", "s2").agg(F.min(first).alias("first"), F.any_value("keys").alias("keys"))
    classes = materialise(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    buckets = materialise(_buckets(classes), "buckets")
    full = materialise(_full_sets(buckets.select("node").distinct(), classes, source, near), "full")
    stars = materialise(_stars(buckets, classes, full, near), "stars")
    rest = materialise(_rest(buckets, connected_components(stars), full, near), "rest")
    joined = connected_components(stars.unionByName(rest))
    of = joined.select(F.col("node").alias("of"), "component")
    grouped = classes.join(of, F.col("node") == F.col("of"), "left").select("n", "s1", "s2", "first", F.coalesce("component", "node").alias("component"))
    grouped = materialise(grouped, "grouped")
    heads = grouped.groupBy("component").agg(F.min("first").alias("head")).withColumnRenamed("component", "c")
    placed = grouped.join(heads, F.col("component") == F.col("c")).select(
        *[F.col(c).alias(f"of_{c}") for c in ("n", "s1", "s2")], F.col("head.id").alias("head_id"), F.col("head.no").alias("head_no")
    )
    match = (F.col("n") == F.col("of_n")) & (F.col("s1") == F.col("of_s1")) & (F.col("s2") == F.col("of_s2"))
    wordless = F.col("n") == 0
    return sets.drop("keys").join(placed, match, "left").select(
        "row", "id", F.col("n").alias("n_shingles"), F.when(wordless, F.col("id")).otherwise(F.col("head_id")).alias("component_id"),
        (wordless | (F.col("no") == F.col("head_no"))).alias("kept"),
    )


def kept_documents(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """The columns of ``docs``, one row of each component and all rows without words."""
    found = near_duplicates(docs, near, keep=docs.columns).where("kept")
    return found.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
