"""Exact n-gram Jaccard join by T-occurrence search, with links as connected components.

Two sets with a Jaccard similarity of at least t share at least T = t/(1+t) (|x|+|y|) shingles.
DivideSkip divides a set's inverted lists: the short ones are merged, counting occurrences; the
L others are only probed, by binary search, for sets that occur T - L times in the short ones.

1. Documents become sets of 64-bit shingle hashes. Equal sets are one class.
2. Routing. Of every set the shingles below a hash cut are posted (or its p first ones, if those
   are fewer). Lists of up to MERGED sets are merged: they give pairs with counts. Longer lists
   are not; a set with fewer than p short lists is posted in as many of its long ones as are
   missing. In the order (short, long, above the cut; by hash) these are the first p shingles,
   and two similar sets share one of their first p = |x| - ceil(t |x|) + 1. Pairs must reach
   T - L, L counting all that was not merged.
3. The components of those pairs and long lists are groups that no link leaves. A group is cut
   into chunks of bounded size; every pair of chunks whose set sizes allow links is searched in
   one task by DivideSkip over their whole sets, which decides the links exactly.
4. Links are joined to components; only a spanning forest of them leaves a task.

No pair of a large group is listed beyond its task, and no list, group or set is cut short.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneloom.llm import scan
from paneloom.llm.components import connected_components
from paneloom.llm.ordering import running_totals
from paneloom.store import materialise

#: The cut lies above the prefixes' share of a set by this factor, so that most sets have a prefix below it.
ABOVE_PREFIX = 4 / 3
#: Length up to which a posting list is merged.
MERGED = 16
#: Shingles in a chunk of a group, about (8 bytes each).
CHUNK = 1 << 18


@dataclass(frozen=True)
class Threshold:
    """Links need 100 * intersection >= percent * union."""

    percent: int

    def least(self, n):
        """ceil(percent/100 * n): the least overlap with any set that n elements can link to."""
        return (n * self.percent + 99) // 100

    def prefix(self, n):
        return n - self.least(n) + 1

    def overlap(self, n, m):
        """T: the least overlap of linked sets of n and m elements."""
        return -((-(n + m) * self.percent) // (100 + self.percent))


def _sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, by text and hash, and the size of every set."""
    data, offsets = scan.buffer(texts)
    hashes, text, _ = scan.windows(scan.Words(scan.LOWER[data], offsets), width)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return hashes[new], np.bincount(text[new], minlength=len(texts))


def _blobs(values: np.ndarray, counts: np.ndarray, kind: str = "<u8") -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64) * np.dtype(kind).itemsize
    data = pa.py_buffer(np.ascontiguousarray(values, kind).tobytes())
    return pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets), data]).cast(pa.binary())


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _summarise(source: DataFrame, width: int, limit: Threshold) -> DataFrame:
    """Per row (id, text, content): size, a 128-bit identity of the set, and its posted hashes in order."""
    below = np.uint64(int(ABOVE_PREFIX * (100 - limit.percent) / 100 * 2**64) if limit.percent > 25 else 2**64 - 1)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in scan.slices(batch, 1):
                hashes, counts = _sets(part.column(1), width)
                ends = np.cumsum(counts)
                starts = ends - counts
                sums = []
                for salt in (1, 2):  # sums do not depend on the order
                    total = np.zeros(len(hashes) + 1, np.uint64)
                    np.cumsum(scan.mix(hashes + np.uint64(salt)), out=total[1:])
                    sums.append(total[ends] - total[starts])
                under = scan.sum_by(hashes < below, starts, ends)
                posted = np.where(counts > 0, np.maximum(under, limit.prefix(counts)), 0)
                within = np.arange(len(hashes)) - np.repeat(starts, counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(2), pa.array(counts.astype(np.int64)), _signed(sums[0]), _signed(sums[1]),
                        pa.array(under.astype(np.int64)), _blobs(hashes[within < np.repeat(posted, counts)], posted),
                    ],
                    names=["id", "content", "n", "s1", "s2", "under", "posted"],
                )

    return source.mapInArrow(summarise, "id long, content long, n long, s1 long, s2 long, under long, posted binary")


def _postings(sets: DataFrame) -> DataFrame:
    """(h, id, n, under): one row per posted hash."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                blobs = part.column(3).to_pylist()
                counts = np.array([len(b) // 8 for b in blobs], np.int64)
                of = pa.array(np.repeat(np.arange(len(blobs)), counts))
                h = np.frombuffer(b"".join(blobs), "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(h), *[part.column(i).take(of) for i in range(3)]], names=["h", "id", "n", "under"])

    return sets.select("id", "n", "under", "posted").mapInArrow(explode, "h long, id long, n long, under long")


def _scan_lists(postings: DataFrame, limit: Threshold) -> DataFrame:
    """Read the lists in order. Short ones give (x, y, shared) pairs of sizes that may link, long ones (h, x)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = np.zeros((4, 0), np.int64)
        long_list: int | None = None  # the list that the last rows belonged to, if it is known to be long
        for batch in batches:
            rows = np.concatenate([waiting, np.stack([batch.column(i).to_numpy() for i in range(4)])], axis=1)
            if not rows.shape[1]:
                continue
            last = int(rows[0, -1])
            other = np.flatnonzero(rows[0] != last)
            start = int(other[-1]) + 1 if len(other) else 0
            # The last list may go on; one that is long already need not wait.
            is_long = last == long_list or rows.shape[1] - start > MERGED
            done = rows.shape[1] if is_long else start
            yield from _lists(rows[:, :done], [h for h in (long_list, last if is_long else None) if h is not None], limit)
            waiting, long_list = rows[:, done:], last if is_long else None
        yield from _lists(waiting, [], limit)

    return postings.mapInArrow(read, "h long, x long, nx long, ux long, y long, ny long, uy long, shared long")


def _lists(rows: np.ndarray, known_long: list[int], limit: Threshold) -> Iterator[pa.RecordBatch]:
    if not rows.shape[1]:
        return
    new = np.ones(rows.shape[1], bool)
    new[1:] = rows[0, 1:] != rows[0, :-1]
    number = np.cumsum(new) - 1
    length = np.bincount(number)[number]
    is_long = (length > MERGED) | np.isin(rows[0], known_long)
    names = ["h", "x", "nx", "ux", "y", "ny", "uy", "shared"]
    empty = lambda n: pa.nulls(n, pa.int64())
    long_rows = rows[:, is_long]
    if long_rows.shape[1]:
        n = long_rows.shape[1]
        yield pa.RecordBatch.from_arrays([*[pa.array(c) for c in long_rows], *[empty(n)] * 4], names=names)
    rows = rows[:, (length > 1) & ~is_long]
    found = []
    for step in range(1, min(MERGED, rows.shape[1])):
        a, b = rows[:, :-step], rows[:, step:]
        low, high = np.minimum(a[2], b[2]), np.maximum(a[2], b[2])
        same = (a[0] == b[0]) & (a[1] != b[1]) & (100 * low >= limit.percent * high)
        if same.any():
            found.append(np.concatenate([a[1:, same], b[1:, same]]))
    if found:
        pairs = np.concatenate(found, axis=1)
        swap = pairs[0] > pairs[3]
        pairs[:, swap] = pairs[[3, 4, 5, 0, 1, 2]][:, swap]
        pairs = pairs[:, np.lexsort((pairs[3], pairs[0]))]
        first = np.ones(pairs.shape[1], bool)
        first[1:] = (pairs[0, 1:] != pairs[0, :-1]) | (pairs[3, 1:] != pairs[3, :-1])
        at = np.flatnonzero(first)
        shared = np.diff(np.append(at, pairs.shape[1]))
        pairs = pairs[:, at]
        yield pa.RecordBatch.from_arrays([empty(len(at)), *[pa.array(c) for c in pairs], pa.array(shared)], names=names)


def _candidate_edges(lists: DataFrame, limit: Threshold) -> DataFrame:
    """(a, b): pairs that reach T - L on the short lists, and members of a long list with its first one."""
    p = limit.percent
    least = lambda n: F.floor((n * p + 99) / 100).cast("bigint")
    prefix = lambda n: n - least(n) + 1

    members = lists.where("h is not null").select("h", F.col("x").alias("id"), F.col("nx").alias("n"), F.col("ux").alias("under")).distinct()
    members = materialise(members, "long")
    posted = F.greatest(F.col("under"), prefix(F.col("n")))
    # A set has at most as many rows here as it has posted hashes.
    per_set = members.groupBy("id").agg(
        F.first("n").alias("n"), F.first("under").alias("under"), F.count("*").alias("long"),
        F.array_sort(F.collect_list(F.struct(((F.shiftrightunsigned("h", 1)).cast("bigint")).alias("order"), "h"))).alias("lists"),
    )
    per_set = materialise(per_set, "long-of-set")
    missing = prefix(F.col("n")) - (posted - F.col("long"))
    needed = (
        per_set.withColumn("missing", missing).where("missing > 0")
        .select("id", F.explode(F.slice("lists", F.lit(1), F.least(F.col("missing"), F.col("long")).cast("int"))).alias("l"))
        .select("id", F.col("l.h").alias("h"))
    )
    needed = materialise(needed, "long-needed")
    heads = needed.groupBy("h").agg(F.min("id").alias("head")).withColumnRenamed("h", "of")
    by_list = needed.join(heads, F.col("h") == F.col("of")).where("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b"))

    pairs = lists.where("h is null").groupBy("x", "y").agg(
        F.sum("shared").alias("shared"), *[F.first(c).alias(c) for c in ("nx", "ux", "ny", "uy")]
    )
    for side in "xy":
        long = per_set.select(F.col("id").alias(f"of_{side}"), F.col("long").alias(f"l{side}"))
        pairs = pairs.join(long, F.col(side) == F.col(f"of_{side}"), "left")

    def reaches(side: str) -> Column:
        n, under = F.col(f"n{side}"), F.col(f"u{side}")
        t = F.ceil((F.col("nx") + F.col("ny")) * p / F.lit(100 + p))
        merged = F.greatest(F.lit(0), under - F.coalesce(f"l{side}", F.lit(0)))  # at least so many lists below the cut
        return F.col("shared") >= t - (n - merged)

    by_pair = pairs.where(reaches("x") & reaches("y")).select(F.col("x").alias("a"), F.col("y").alias("b"))
    return by_pair.unionByName(by_list)


def search(values: list[np.ndarray], limit: Threshold, asked: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links among the sets (sorted hash arrays), by DivideSkip.

    ``asked`` marks sets that are queried against the others, and not among themselves; without it
    all are queried. A pair that earlier links already connect is not decided again.
    """
    sizes = np.array([len(v) for v in values], np.int64)
    owner = np.repeat(np.arange(len(values)), sizes)
    flat = np.concatenate([*values, np.zeros(0, np.uint64)])
    order = np.argsort(flat, kind="stable")  # owners stay in order within a list
    ordered, owner_of = flat[order], owner[order]
    start = np.ones(len(ordered), bool)
    start[1:] = ordered[1:] != ordered[:-1]
    begins = np.flatnonzero(start)
    lengths = np.diff(np.append(begins, len(ordered)))
    list_of = np.empty(len(flat), np.int64)
    list_of[order] = np.cumsum(start) - 1
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    longest = max(2, int(lengths.max())) if len(lengths) else 2

    parent = list(range(len(values)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    roots = np.arange(len(values))
    for x in range(len(values)) if asked is None else np.flatnonzero(asked):
        x = int(x)
        lists = list_of[offsets[x] : offsets[x + 1]]
        lists = lists[lengths[lists] > 1]
        least = int(limit.least(sizes[x]))
        if len(lists) < least:
            continue
        lists = lists[np.argsort(lengths[lists], kind="stable")]
        aside = min(least - 1, int(least / (0.1 * np.log2(longest) + 1)))  # L, the lists to probe
        short, probed = lists[: len(lists) - aside], lists[len(lists) - aside :]
        members = np.concatenate([owner_of[begins[k] : begins[k] + lengths[k]] for k in short]) if len(short) else np.zeros(0, np.int64)
        counts = np.bincount(members, minlength=len(values))
        near = np.flatnonzero(counts >= max(1, least - len(probed)))
        near = near[near > x] if asked is None else near[~asked[near]]
        near = near[roots[near] != roots[x]]
        low, high = np.minimum(sizes[near], sizes[x]), np.maximum(sizes[near], sizes[x])
        near = near[100 * low >= limit.percent * high]
        if not len(near):
            continue
        shared = counts[near]
        for k in probed:
            on = owner_of[begins[k] : begins[k] + lengths[k]]
            at = np.minimum(np.searchsorted(on, near), len(on) - 1)
            shared += on[at] == near
        for y in near[shared >= limit.overlap(sizes[near], sizes[x])].tolist():
            a, b = root(x), root(y)
            if a != b:
                parent[max(a, b)] = min(a, b)
                yield x, y
        roots = _roots(parent)


def _roots(parent: list[int]) -> np.ndarray:
    up = np.array(parent)
    while True:
        above = up[up]
        if (above == up).all():
            return up
        up = above


def _links(members: DataFrame, docs: DataFrame, firsts: DataFrame, width: int, limit: Threshold) -> DataFrame:
    """(a, b): a spanning forest of the links inside each group (id, n, component).

    ``firsts`` (id, named, content) leads from a set to the id and text of its first row in ``docs`` (id, text, content).
    """
    chunked = running_totals(members, ["component"], ["n", "id"], "n").select(
        "id", "n", "component", F.floor(F.col("before") / F.lit(CHUNK)).cast("int").alias("chunk")
    )
    chunked = materialise(chunked, "chunks")
    spans = chunked.groupBy("component", "chunk").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    first = spans.select(F.col("component").alias("c"), F.col("chunk").alias("i"), F.col("most").alias("most_i"))
    cells = spans.join(
        first, (F.col("component") == F.col("c")) & (F.col("i") <= F.col("chunk")) & (100 * F.col("most_i") >= limit.percent * F.col("least"))
    ).select("c", "i", F.col("chunk").alias("j"))
    cells = materialise(cells, "cells")
    ends = F.explode(F.array_distinct(F.array("i", "j")))
    by_chunk = cells.select("c", "i", "j", ends.alias("k"))

    # The members grow with the documents: these joins are sort-merge joins at every size.
    of = firsts.select(F.col("id").alias("of"), "named", F.col("content").alias("says")).hint("merge")
    wanted = chunked.join(of, F.col("id") == F.col("of")).select(F.col("id").alias("member"), "named", "says", "component", "chunk").hint("merge")
    found = docs.join(wanted, F.col("content").eqNullSafe(F.col("says")) & F.col("id").eqNullSafe(F.col("named")))
    # Repeated rows meet map-side.
    source = found.groupBy(F.col("member").alias("id"), "component", "chunk").agg(F.any_value("text").alias("text"))

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in scan.slices(batch, 1):
                hashes, counts = _sets(part.column(1), width)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), part.column(3), _blobs(hashes, counts)], names=["id", "component", "chunk", "hashes"])

    sets = source.select("id", "text", "component", "chunk").mapInArrow(shingle, "id long, component long, chunk int, hashes binary")
    placed = sets.join(by_chunk, (F.col("component") == F.col("c")) & (F.col("chunk") == F.col("k"))).select("c", "i", "j", "id", "chunk", "hashes")
    pieces = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = placed.repartition(pieces, "c", "i", "j").sortWithinPartitions("c", "i", "j", "chunk", "id")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for cell, rows in _cells(batches):
            ids, chunks, blobs = zip(*rows, strict=True)
            asked = None if cell[1] == cell[2] else np.array([c == cell[1] for c in chunks])
            values = [np.frombuffer(b, "<u8") for b in blobs]
            out.extend((ids[x], ids[y]) for x, y in search(values, limit, asked))
            if len(out) > 10_000:
                yield _edges(out)
                out = []
        if out:
            yield _edges(out)

    return dealt.mapInArrow(find, "a long, b long")


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list]]:
    """The rows of each cell; its chunks bound what is held."""
    cell, rows = None, []
    for batch in batches:
        for c, i, j, *row in zip(*[column.to_pylist() for column in batch.columns], strict=True):
            if (c, i, j) != cell:
                if len(rows) > 1:
                    yield cell, rows
                cell, rows = (c, i, j), []
            rows.append(row)
    if len(rows) > 1:
        yield cell, rows


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id): the connected components of all links between documents.

    A set is the distinct shingles of ``width`` words, A-Z in lower case; a text of fewer words has
    its whole sequence as one. A text that is null or without words has none and links with
    nothing. ``component_id`` is the smallest id reachable by links, null only if no row there
    has an id: rows without an id take part like all others, and so does every text of a repeated id.
    """
    found = _components(docs, doc_id, text, width, percent)
    return found.select("id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("head.id")).alias("component_id"))


def _components(docs: DataFrame, doc_id: str, text: str, width: int, percent: int) -> DataFrame:
    """(id, content, n, head) for every row: ``head`` is the component's first row, by id (null last), null without words."""
    limit = Threshold(percent)
    body = F.col(text).cast("string")
    source = docs.select(F.col(doc_id).cast("bigint").alias("id"), body.alias("text"), F.xxhash64(body).alias("content"))
    # The stored rows are numbered; a set is known by the number of its first row.
    sets = materialise(_summarise(source, width, limit).withColumn("no", F.monotonically_increasing_id()), "sets")
    first = F.struct(F.col("id").isNull().alias("nameless"), "id", "content", "no")
    classes = materialise(sets.where("n > 0").groupBy("n", "s1", "s2").agg(F.min(first).alias("first")), "classes")
    firsts = classes.select("n", F.col("first.no").alias("id"), F.col("first.id").alias("named"), F.col("first.content").alias("content"))
    # One set per class goes on.
    chosen = sets.select(F.col("no").alias("id"), "n", "under", "posted").join(firsts.select("id").hint("merge"), "id", "left_semi")
    pieces = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    postings = _postings(chosen).repartition(pieces, "h").sortWithinPartitions("h", "id")
    lists = materialise(_scan_lists(postings, limit), "lists")
    groups = connected_components(_candidate_edges(lists, limit))
    sizes = firsts.select("id", "n")
    members = materialise(groups.join(sizes, F.col("node") == F.col("id")).select("id", "n", "component"), "members")
    links = connected_components(_links(members, source, firsts, width, limit))
    linked = links.select(F.col("node").alias("linked"), "component")
    labelled = classes.join(linked, F.col("first.no") == F.col("linked"), "left")
    grouped = materialise(labelled.select("n", "s1", "s2", "first", F.coalesce("component", "first.no").alias("component")), "grouped")
    heads = grouped.groupBy("component").agg(F.min("first").alias("head")).withColumnRenamed("component", "c")
    of_class = grouped.join(heads, F.col("component") == F.col("c")).select(*[F.col(c).alias(f"of_{c}") for c in ("n", "s1", "s2")], "head")
    same = (F.col("n") == F.col("of_n")) & (F.col("s1") == F.col("of_s1")) & (F.col("s2") == F.col("of_s2"))
    return sets.join(of_class, same, "left").select("id", "content", "n", "head")


def first_of_groups(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The columns of ``docs``, one row of each component: the first by id (null last) and text. Rows without words stay."""
    found = _components(docs, "doc_id", "text", width, percent)
    is_head = F.col("id").eqNullSafe(F.col("head.id")) & F.col("content").eqNullSafe(F.col("head.content"))
    kept = found.where((F.col("n") == 0) | is_head).groupBy(F.col("id").alias("kept_id"), F.col("content").alias("kept_content"))
    kept = materialise(kept.agg((F.sum((F.col("n") > 0).cast("int")) > 1).alias("repeated")), "kept")
    content = F.xxhash64(F.col("text").cast("string"))
    marked = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("id"), content.alias("content")).join(
        kept.hint("merge"), F.col("id").eqNullSafe(F.col("kept_id")) & F.col("content").eqNullSafe(F.col("kept_content"))
    )
    columns = [F.col("row").getField(c).alias(c) for c in docs.columns]
    once = marked.where("not repeated").select(*columns)
    if kept.where("repeated").isEmpty():
        return once
    # Rows that repeat both id and text: one of each.
    return once.unionByName(marked.where("repeated").dropDuplicates(["id", "content"]).select(*columns))
