"""Growing a forest: MLlib's binned regression trees, grown a tree at a time over binned rows instead of a level of all trees at a time.

MLlib adds up split statistics of every open node over the partitions, a dense table of features and bins for each node: with hundreds
of deep trees these tables are far larger than the rows, and they are what its fit spends its time on. Here the rows are
binned once (a byte a feature), stored, and read by each task, which grows its share of the trees in memory, a level at a time. The
trees leave the tasks as rows in the form in which MLlib stores a forest, from which they are walked or loaded as its model.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneloom.store import new_path

#: Rows whose values place the thresholds: all of them up to this number, else about as many, drawn by a hash. MLlib takes 10,000.
SAMPLE = 100_000
#: Bytes of binned rows and labels that a task holds; a larger table is fitted by MLlib, in as many passes as it takes.
HELD = 256_000_000
#: Cells of split statistics held at once, and rows added up at once.
CELLS, CHUNK = 4_000_000, 1 << 18
#: Shares of a node's sum of squares below which two splits count as equally good, and a node as pure.
EQUAL, PURE = 1e-10, 1e-12

_NODE = (
    "tree int, id int, prediction double, impurity double, stats array<double>, raw bigint, gain double, left int, right int, "
    "feature int, split array<double>, kinds int"
)


@dataclass(frozen=True)
class Rules:
    """What of MLlib's parameters decides about trees grown on all features."""

    trees: int
    depth: int
    bins: int
    seed: int
    rate: float
    bootstrap: bool
    least: float
    least_gain: float


def rules_of(estimator: RandomForestRegressor) -> Rules | None:
    """None for a forest that draws features at each split, weighs rows, names leaves or has more bins than two bytes hold."""
    every = estimator.getFeatureSubsetStrategy() == "all"
    plain = not estimator.isDefined("weightCol") and not estimator.getLeafCol() and estimator.getMinWeightFractionPerNode() == 0
    if not (every and plain and estimator.getImpurity() == "variance" and estimator.getMaxBins() <= 65_536):
        return None
    return Rules(
        estimator.getNumTrees(), estimator.getMaxDepth(), estimator.getMaxBins(), estimator.getSeed(), estimator.getSubsamplingRate(),
        estimator.getBootstrap(), estimator.getMinInstancesPerNode(), estimator.getMinInfoGain(),
    )


def thresholds(values: np.ndarray, bins: int) -> np.ndarray:
    """MLlib's: midpoints of neighbouring values, all of them or those nearest to equal shares of the rows."""
    distinct, counts = np.unique(values, return_counts=True)
    middle = (distinct[1:] + distinct[:-1]) / 2
    if len(middle) <= bins - 1:
        return middle
    below = np.cumsum(counts)
    twice = below[1:] + below[:-1]
    stride, at, found = len(values) / bins, 0, []
    for k in range(1, bins):
        at = max(at, int(np.searchsorted(twice, 2 * k * stride, "right")))
        if at >= len(middle):
            break
        found.append(at)
        at += 1
    return middle[found]


def mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bag(rules: Rules, tree: int, n: int) -> np.ndarray:
    """How often each of ``n`` rows is in a tree's bag: a property of the seed, the tree and the row's number."""
    if not rules.bootstrap and rules.rate >= 1:
        return np.ones(n, np.uint8)
    counts = [0.0, 1.0]
    if rules.bootstrap:
        counts = np.cumsum([np.exp(-rules.rate) * reduce(lambda p, k: p * rules.rate / k, range(1, i + 1), 1.0) for i in range(40)])
    key = mixed(mixed(np.array([rules.seed & (2**64 - 1)], np.uint64)) + np.uint64(tree))
    out = np.empty(n, np.uint8)
    for i in range(0, n, CHUNK):
        rows = np.arange(i, min(n, i + CHUNK), dtype=np.uint64)
        u = (mixed(rows ^ key) >> np.uint64(11)).astype(float) / 2.0**53
        out[i : i + len(rows)] = np.searchsorted(counts, u, "right") if rules.bootstrap else u < rules.rate
    return out


class _Rows:
    """The rows of a bag that lie in open nodes: their numbers, and the node of each."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        self.x, self.y, self.weight = x, y, weight
        self.at = np.flatnonzero(weight).astype(np.int32 if len(y) < 2**31 else np.int64)
        self.node = np.zeros(len(self.at), np.int32)

    def chunks(self, chosen: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for i in range(0, len(self.at), CHUNK):
            at, node = self.at[i : i + CHUNK], self.node[i : i + CHUNK]
            if chosen is not None:
                kept = chosen[node]
                at, node = at[kept], node[kept]
            if len(at):
                yield at, node.astype(np.int64)

    def totals(self, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Weight, sum and sum of squares of the labels of each node."""
        out = np.zeros((3, m))
        for at, node in self.chunks():
            w, y = self.weight[at].astype(float), self.y[at]
            for i, v in enumerate((w, w * y, w * y * y)):
                out[i] += np.bincount(node, v, m)
        return out[0], out[1], out[2]

    def tables(self, m: int, sizes: Sequence[int], chosen: np.ndarray | None = None) -> list[np.ndarray]:
        """For each feature, (weight, sum) by node and bin, of the chosen nodes or of all."""
        out = [np.zeros((2, m * b)) for b in sizes]
        for at, node in self.chunks(chosen):
            w = self.weight[at].astype(float)
            wy = w * self.y[at]
            for table, values, b in zip(out, self.x, sizes, strict=True):
                key = node * b
                key += values[at]
                table[0] += np.bincount(key, w, m * b)
                table[1] += np.bincount(key, wy, m * b)
        return [t.reshape(2, m, b) for t, b in zip(out, sizes, strict=True)]

    def by_node(self, m: int, most: int) -> Iterator[tuple[int, int, _Rows]]:
        """The rows of so many nodes at a time that a feature's table stays within bounds."""
        order = np.argsort(self.node, kind="stable")
        self.at, self.node = self.at[order], self.node[order]
        step = max(1, CELLS // most)
        for low in range(0, m, step):
            high = min(m, low + step)
            i, j = np.searchsorted(self.node, [low, high])
            part = object.__new__(_Rows)
            part.x, part.y, part.weight = self.x, self.y, self.weight
            part.at, part.node = self.at[i:j], self.node[i:j] - np.int32(low)
            yield low, high, part

    def move(self, splits: np.ndarray, feature: np.ndarray, cut: np.ndarray, p: int) -> None:
        """Into the children of the nodes that split, numbered in order; rows of the others are done."""
        rank = (np.cumsum(splits) - 1) * 2
        at, nodes = [], []
        for i in range(0, len(self.at), CHUNK):
            rows, node = self.at[i : i + CHUNK], self.node[i : i + CHUNK]
            kept = splits[node]
            rows, node = rows[kept], node[kept]
            f = feature[node]
            value = self.x[f, rows]
            right = np.where(f < p, value > cut[node], value == cut[node])
            at.append(rows)
            nodes.append((rank[node] + right).astype(np.int32))
        self.at, self.node = np.concatenate(at), np.concatenate(nodes)


def _best(tables: list[np.ndarray], n: np.ndarray, s: np.ndarray, equal: np.ndarray, least: float, p: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each node the score, feature and cut of the first split that no other is better than by more than ``equal``.

    A numeric feature's cut is the last bin that goes left, the group's (feature ``p``) the slot that goes right. The score
    is the sum of squares that the children's means explain.
    """
    score, feature, cut = np.full(len(n), -np.inf), np.zeros(len(n), np.int32), np.zeros(len(n), np.int32)
    for j, (count, total) in enumerate(tables):
        if j < p:
            count, total = np.cumsum(count[:, :-1], 1), np.cumsum(total[:, :-1], 1)
        if not count.shape[1]:
            continue
        rest, others = n[:, None] - count, s[:, None] - total
        with np.errstate(divide="ignore", invalid="ignore"):
            value = total * total / count + others * others / rest
        value[(count < least) | (rest < least)] = -np.inf
        best = value.max(1)
        first = (value >= (best - equal)[:, None]).argmax(1)
        better = best > score + equal
        score[better], feature[better], cut[better] = best[better], j, first[better]
    return score, feature, cut


def grow(x: np.ndarray, y: np.ndarray, weight: np.ndarray, sizes: Sequence[int], rules: Rules) -> dict[str, np.ndarray]:
    """One tree's nodes, level by level, children side by side. ``x`` has a row for each numeric feature's bins and a last one for the slots."""
    p, rows, cells = len(sizes) - 1, _Rows(x, y, weight), sum(sizes)
    least = max(1.0, rules.least)
    nodes: dict[str, list[np.ndarray]] = {k: [] for k in ("n", "s", "q", "gain", "left", "feature", "cut")}
    m, first, above, smaller = 1, 0, None, None
    for depth in range(rules.depth + 1):
        n, s, q = rows.totals(m)
        left, gain = np.full(m, -1, np.int32), np.full(m, -1.0)
        feature, cut, splits = np.full(m, -1, np.int32), np.zeros(m, np.int32), np.zeros(m, bool)
        if depth < rules.depth and len(rows.at):
            equal = EQUAL * q
            open_ = (q - s * s / n > PURE * q) & (n >= 2 * least)
            if m * cells <= CELLS:
                tables = rows.tables(m, sizes, smaller)
                if smaller is not None:  # the larger child has what the smaller one leaves
                    for t, before in zip(tables, above, strict=True):
                        other = np.flatnonzero(~smaller)
                        t[:, other] = before[:, other >> 1] - t[:, other ^ 1]
                        t[1][t[0] == 0] = 0.0
                score, feature, cut = _best(tables, n, s, equal, least, p)
            else:
                tables, found = None, []
                for low, high, part in rows.by_node(m, max(sizes)):
                    one = _by_feature(part, high - low, sizes, n[low:high], s[low:high], equal[low:high], least, p)
                    found.append(one)
                score, feature, cut = (np.concatenate(c) for c in zip(*found, strict=True))
            gain = np.where(np.isfinite(score), (score - s * s / n) / n, -1.0)
            splits = open_ & (gain * n > equal) & (gain >= rules.least_gain)
            left[splits] = first + m + 2 * np.arange(splits.sum())
        for k, v in (("n", n), ("s", s), ("q", q), ("gain", np.where(splits, gain, -1.0)), ("left", left), ("feature", np.where(splits, feature, -1)), ("cut", cut)):
            nodes[k].append(v)
        if not splits.any():
            break
        rows.move(splits, feature, cut, p)
        first, m = first + m, 2 * int(splits.sum())
        above = smaller = None
        if tables is not None and m * cells <= CELLS:
            above = [t[:, splits] for t in tables]
            size = np.bincount(rows.node, minlength=m)
            smaller = np.zeros(m, bool)
            smaller[0::2] = size[0::2] <= size[1::2]
            smaller[1::2] = ~smaller[0::2]
        tables = None
    return {k: np.concatenate(v) for k, v in nodes.items()}


def _by_feature(rows: _Rows, m: int, sizes: Sequence[int], n: np.ndarray, s: np.ndarray, equal: np.ndarray, least: float, p: int):
    """``_best`` with one feature's table at a time."""
    score, feature, cut = np.full(m, -np.inf), np.zeros(m, np.int32), np.zeros(m, np.int32)
    x = rows.x
    for j, b in enumerate(sizes):
        rows.x = x[j : j + 1]
        value, _, at = _best(rows.tables(m, [b]), n, s, equal, least, 1 if j < p else 0)
        better = value > score + equal
        score[better], feature[better], cut[better] = value[better], j, at[better]
    return score, feature, cut


def fit_trees(
    estimator: RandomForestRegressor, rows: DataFrame, numeric: Sequence[str], n_levels: int, count: int, centre: np.ndarray, scale: np.ndarray, factor: np.ndarray
) -> str | None:
    """The path of the stored forest, or None if it has to be MLlib's own fit. ``rows`` come in a fixed order, with ``_group_no``.

    ``centre``, ``scale`` and ``factor`` are those of the z-scores that the model's pipeline makes.
    """
    rules = rules_of(estimator)
    p, label = len(numeric), estimator.getLabelCol()
    wide = rules is not None and max(rules.bins, n_levels + 1) > 256
    if rules is None or not count or count * ((p + 1) * (2 if wide else 1) + 8) > HELD:
        return None
    spark, kind = rows.sparkSession, np.uint16 if wide else np.uint8
    columns = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(numeric)]

    def scaled(batch) -> np.ndarray:
        x = np.stack([batch.column(f"x{i}").to_numpy(zero_copy_only=False) for i in range(p)], axis=1).astype(float)
        return (x - centre) * scale * factor

    sample = rows.select(*columns)
    if count > SAMPLE:
        sample = sample.where(F.pmod(F.xxhash64(*sample.columns), F.lit(1_000_000)) < F.lit(round(1e6 * SAMPLE / count)))
    drawn = [scaled(b) for b in sample.toArrow().to_batches() if b.num_rows]
    z = np.concatenate(drawn) if drawn else np.zeros((0, p))
    cuts = [thresholds(z[:, i], rules.bins) for i in range(p)]
    sizes = [*[len(c) + 1 for c in cuts], n_levels + 1]
    mean = rows.agg(F.avg(F.col(label).cast("double"))).first()[0]

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = scaled(batch)
            bins = np.stack([*[np.searchsorted(c, z[:, i], "left") for i, c in enumerate(cuts)], batch.column("slot").to_numpy()], axis=1).astype(kind)
            ends = pa.py_buffer(np.arange(len(bins) + 1, dtype=np.int32) * (bins.itemsize * (p + 1)))
            cells = pa.Array.from_buffers(pa.binary(), len(bins), [None, ends, pa.py_buffer(np.ascontiguousarray(bins))])
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("y"), cells], names=["row", "y", "bins"])

    source = rows.select(*columns, F.col("_group_no").cast("bigint").alias("slot"), F.col(label).cast("double").alias("y"), F.monotonically_increasing_id().alias("row"))
    path = new_path(spark, "binned")
    source.mapInArrow(binned, "row bigint, y double, bins binary").write.parquet(path)
    stored = spark.read.schema("row bigint, y double, bins binary").parquet(path)
    part = F.shiftright("row", 33).cast("int").alias("part")  # of which monotonically_increasing_id makes its numbers
    sent = {r.part: r.n for r in stored.groupBy(part).agg(F.count("*").alias("n")).collect()}
    begins = np.zeros(max(sent) + 2, np.int64)
    begins[np.array(list(sent)) + 1] = list(sent.values())
    begins = np.cumsum(begins)
    n = int(begins[-1])

    def trees_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y, share = np.empty((p + 1, n), kind), np.empty(n), None
        for batch in (b for b in batches if b.num_rows):
            share = batch.column("share")[0].as_py()
            row = batch.column("row").to_numpy()
            at = begins[row >> 33] + (row & ((1 << 33) - 1))
            cells, width = batch.column("bins"), x.itemsize * (p + 1)
            raw = np.frombuffer(cells.buffers()[2], np.uint8)
            begin = int(np.frombuffer(cells.buffers()[1], np.int32)[cells.offset])
            x[:, at] = raw[begin : begin + len(at) * width].view(kind).reshape(len(at), p + 1).T
            y[at] = batch.column("y").to_numpy() - mean
        for tree in range(share, rules.trees, shares) if share is not None else ():
            yield _as_rows(tree, grow(x, y, bag(rules, tree, n), sizes, rules), cuts, p, mean)

    shares = max(1, min(rules.trees, 4 * spark.sparkContext.defaultParallelism))
    # Every task reads the stored rows; nothing is shuffled. Tables of one partition each would be united into one partition, so a scan of no rows goes with them.
    whole = [stored.coalesce(1).withColumn("share", F.lit(i)) for i in range(shares)]
    grown = reduce(DataFrame.union, whole, stored.where("row < 0").withColumn("share", F.lit(-1))).mapInArrow(trees_of, _NODE)
    return _stored(estimator, grown, p + n_levels)


def _as_rows(tree: int, nodes: dict[str, np.ndarray], cuts: Sequence[np.ndarray], p: int, mean: float) -> pa.RecordBatch:
    """A tree in the columns of _NODE. Labels were taken from ``mean``."""
    n, s, left, feature, cut = nodes["n"], nodes["s"], nodes["left"], nodes["feature"], nodes["cut"]
    inner, slot = left >= 0, feature == p
    value = np.zeros(len(n))
    for i, c in enumerate(cuts):
        own = inner & (feature == i)
        value[own] = c[cut[own]]
    ends = np.concatenate([[0], np.cumsum(inner)]).astype(np.int32)  # a slot's 0 goes left
    total, each = s + n * mean, np.maximum(n, 1.0)  # the bag of a few rows may be empty
    stats = np.stack([n, total, nodes["q"] + 2 * mean * s + n * mean * mean], axis=1).reshape(-1)
    arrays = [
        pa.array(np.full(len(n), tree, np.int32)), pa.array(np.arange(len(n), dtype=np.int32)), pa.array(mean + s / each),
        pa.array(np.maximum(nodes["q"] / each - (s / each) ** 2, 0.0)), pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * 3), pa.array(stats)),
        pa.array(n.astype(np.int64)), pa.array(nodes["gain"]), pa.array(left), pa.array(np.where(inner, left + 1, -1).astype(np.int32)),
        pa.array(np.where(slot, p + cut, feature).astype(np.int32)), pa.ListArray.from_arrays(pa.array(ends), pa.array(value[inner])),
        pa.array(np.where(slot, 2, -1).astype(np.int32)),
    ]
    names = [c.split()[0] for c in _NODE.split(", ")]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _stored(estimator: RandomForestRegressor, grown: DataFrame, features: int) -> str:
    """The grown trees in the form in which MLlib stores its model."""
    spark = grown.sparkSession
    path = new_path(spark, "forest")
    split = F.struct(F.col("feature").alias("featureIndex"), F.col("split").alias("leftCategoriesOrThreshold"), F.col("kinds").alias("numCategories"))
    node = F.struct(
        "id", "prediction", "impurity", F.col("stats").alias("impurityStats"), F.col("raw").alias("rawCount"), "gain",
        F.col("left").alias("leftChild"), F.col("right").alias("rightChild"), split.alias("split"),
    )
    grown.select(F.col("tree").alias("treeID"), node.alias("nodeData")).write.parquet(f"{path}/data")
    estimator.write().save(f"{path}/estimator")
    about = json.loads(spark.read.text(f"{path}/estimator/metadata").first()[0])
    trees = estimator.getNumTrees()
    model = about | {"class": "org.apache.spark.ml.regression.RandomForestRegressionModel", "numFeatures": features, "numTrees": trees}
    spark.createDataFrame([(json.dumps(model),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    forests = ("numTrees", "featureSubsetStrategy", "bootstrap", "subsamplingRate")
    tree = about | {"class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel"}
    tree |= {k: {name: v for name, v in about[k].items() if name not in forests} for k in ("paramMap", "defaultParamMap")}
    rows = [(i, json.dumps(tree | {"uid": f"dtr_{uuid.uuid4().hex[:12]}"}), 1.0) for i in range(trees)]
    spark.createDataFrame(rows, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    return path
