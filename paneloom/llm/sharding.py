"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Under a uniform permutation of all rows, the numbers of rows that each partition sends to each
shard follow a multivariate hypergeometric law whose margins are the partitions' row counts and
the shards' sizes. The matrix is drawn first, exactly; every partition then permutes its rows
and cuts them at its matrix row, the pieces are exchanged, and every shard permutes again.

All of it is column expressions. The matrix is drawn down a binary tree over the partitions, level by level, as
a table of one row per node: a node's places in the shards are divided between its halves by
hypergeometric draws, once, at a cost that does not grow with the rows; the uniform numbers come from a
hash of the seed and the node.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneloom.store import deal, materialise

#: Rows that one task permutes within a shard, about.
ROWS_PER_PIECE = 20_000


def _uniform(*parts: Column) -> Column:
    """In (0, 1), from a hash."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 12).cast("double") + 0.5) / F.lit(2.0**52)


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _log_factorial(n: Column) -> Column:
    """Stirling's series; its error is below 1e-10 from 9 on, smaller numbers are stated."""
    small = F.array(*[F.lit(math.lgamma(k + 1)) for k in range(9)])
    x = n.cast("double")
    series = (x + 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * F.pow(x, F.lit(5)))
    return F.when(n < 9, F.get(small, n.cast("int"))).otherwise(series)


def _log_ratio(a: Column, b: Column) -> Column:
    """log(a! / b!), for numbers next to each other relative to their size, without the cancellation of large logarithms."""
    x, y = a.cast("double"), b.cast("double")
    tail = lambda z: 1 / (12 * z) - 1 / (360 * z * z * z)
    near = (y + 0.5) * F.log1p((x - y) / y) + (x - y) * (F.log(x) - 1) + tail(x) - tail(y)
    return F.when(F.least(a, b) < 40, _log_factorial(a) - _log_factorial(b)).otherwise(near)


#: Spread up to which a draw walks outwards from the mode; and attempts of a wider draw, of which about one in four fails.
WALKED, ATTEMPTS = 16.0, 40


def hypergeometric(total: Column, good: Column, drawn: Column, u: Column) -> Column:
    """How many good ones are among ``drawn`` of ``total``.

    Narrow laws are inverted outwards from the mode, twelve deviations to either side; what lies beyond has less
    probability than the doubles resolve. Wide ones are drawn by the ratio of uniforms (Stadlober's table mountain hat), whose
    uniform numbers are hashes of ``u``: the cost does not depend on the spread.
    """

    def draw(p: Column) -> Column:
        n, k, m = p["n"], p["k"], p["m"]
        low, high = F.greatest(F.lit(0), m + k - n), F.least(k, m)
        mode = F.greatest(low, F.least(high, F.floor((m + 1).cast("double") * (k + 1) / (n + 2)).cast("bigint")))
        spread = F.sqrt(m.cast("double") * k / n * (n - k) / n * (n - m) / F.greatest(n - 1, F.lit(1)))
        frame = F.struct(low.alias("low"), high.alias("high"), mode.alias("mode"), spread.alias("spread"))
        chosen = lambda q: F.when(q["spread"] <= WALKED, _from_mode(p, q)).otherwise(_by_ratio(p, q))
        return F.when(low >= high, low).otherwise(_let(frame, chosen))

    big = lambda c: c.cast("bigint")
    return _let(F.struct(big(total).alias("n"), big(good).alias("k"), big(drawn).alias("m"), u.alias("u")), draw)


def _from_mode(p: Column, q: Column) -> Column:
    n, k, m = p["n"], p["k"], p["m"]
    comb = lambda a, b: _log_factorial(a) - _log_factorial(b) - _log_factorial(a - b)
    # The weight of the mode, by logarithms that nearly cancel; the walk's own weights add up to 1 with it.
    weight = F.exp(comb(k, q["mode"]) + comb(n - k, m - q["mode"]) - comb(n, m))
    start = F.struct(
        (p["u"] - weight).alias("left"), weight.alias("up"), weight.alias("down"),
        F.when(p["u"] <= weight, q["mode"]).alias("found"),
    )

    def step(s: Column, i: Column) -> Column:
        x, y = q["mode"] + i, q["mode"] - i
        up = F.when(
            x <= q["high"], s["up"] * ((k - x + 1).cast("double") * (m - x + 1)) / (x.cast("double") * (n - k - m + x))
        ).otherwise(F.lit(0.0))
        down = F.when(
            y >= q["low"], s["down"] * ((y + 1).cast("double") * (n - k - m + y + 1)) / ((k - y).cast("double") * (m - y))
        ).otherwise(F.lit(0.0))
        moved = F.struct(s["left"].alias("left"), up.alias("up"), down.alias("down"), s["found"].alias("found"))
        hit = lambda t: F.when(t["found"].isNotNull(), t["found"]).when(t["left"] <= t["up"], x).when(t["left"] <= t["up"] + t["down"], y)
        return F.when(s["found"].isNotNull(), s).otherwise(
            _let(moved, lambda t: F.struct((t["left"] - t["up"] - t["down"]).alias("left"), t["up"].alias("up"), t["down"].alias("down"), hit(t).alias("found")))
        )

    steps = F.ceil(12 * q["spread"] + 12).cast("bigint")
    return F.aggregate(F.sequence(F.lit(1).cast("bigint"), steps), start, step, lambda s: F.coalesce(s["found"], q["mode"]))


def _by_ratio(p: Column, q: Column) -> Column:
    n, k, m = p["n"], p["k"], p["m"]
    centre = m.cast("double") * k / n + 0.5
    # Fixed values of the method: 2 sqrt(2/e) and 3 - 2 sqrt(3/e).
    width = 2 * math.sqrt(2 / math.e) * F.sqrt(q["spread"] * q["spread"] + 0.5) + (3 - 2 * math.sqrt(3 / math.e))

    def attempt(found: Column, i: Column) -> Column:
        x, y = _uniform(p["u"], i, F.lit("x")), _uniform(p["u"], i, F.lit("y"))

        def judge(t: Column) -> Column:
            z = t["z"]
            # The logarithm of the law at z over that at the mode.
            height = -(
                _log_ratio(z, q["mode"]) + _log_ratio(k - z, k - q["mode"]) + _log_ratio(m - z, m - q["mode"]) + _log_ratio(n - k - m + z, n - k - m + q["mode"])
            )
            return F.when((z >= q["low"]) & (z <= q["high"]) & (2 * F.log(t["x"]) <= height), z)

        place = F.floor(centre + width * (y - 0.5) / x).cast("bigint")
        return F.when(found.isNotNull(), found).otherwise(_let(F.struct(x.alias("x"), place.alias("z")), judge))

    tried = F.aggregate(F.sequence(F.lit(1), F.lit(ATTEMPTS)), F.lit(None).cast("bigint"), attempt)
    return F.coalesce(tried, q["mode"])


def communication_matrix(counts: DataFrame, shards: int, seed: int) -> DataFrame:
    """(part, sends): how many rows every partition sends to each shard.

    ``counts`` has one row (part, n) per partition. Node j of a level holds the partitions whose number
    in order, shifted right by the level, is j; a level's table has the nodes' places, drawn from the level above.
    """
    numbered = materialise(counts.select("part", "n", (F.row_number().over(Window.orderBy("part")) - 1).cast("bigint").alias("leaf")), "partitions")
    width, rows = numbered.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    depth = max(1, (max(width, 2) - 1).bit_length())
    levels = F.explode(F.sequence(F.lit(0), F.lit(depth)))
    sizes = materialise(
        numbered.select("leaf", "n", levels.alias("level")).groupBy("level", F.expr("shiftright(leaf, level)").alias("node")).agg(F.sum("n").alias("n")), "tree"
    )
    places = [rows // shards + (j < rows % shards) for j in range(shards)]
    nodes = sizes.where(F.col("level") == depth).select("node", F.array(*[F.lit(p).cast("bigint") for p in places]).alias("places"))
    for level in range(depth - 1, -1, -1):
        lower = sizes.where((F.col("level") == level) & (F.col("node") % 2 == 0)).select(F.shiftright("node", 1).alias("of"), "n")
        upper = sizes.where((F.col("level") == level) & (F.col("node") % 2 == 1)).select(F.shiftright("node", 1).alias("of_upper"))
        both = nodes.join(lower, F.col("node") == F.col("of")).join(upper, F.col("node") == F.col("of_upper"), "left")
        drawn = deal(both).withColumn("low", F.when(F.col("of_upper").isNull(), F.col("places")).otherwise(_divide(F.col("places"), F.col("n"), shards, seed, level)))
        halves = F.array(
            F.struct((F.col("node") * 2).alias("node"), F.col("low").alias("places")),
            F.struct((F.col("node") * 2 + 1).alias("node"), F.zip_with("places", "low", lambda a, b: a - b).alias("places")),
        )
        kept = drawn.select(F.explode(F.when(F.col("of_upper").isNull(), F.slice(halves, 1, 1)).otherwise(halves)).alias("half")).select("half.*")
        nodes = materialise(kept, "level")
    return numbered.join(nodes, F.col("leaf") == F.col("node")).select("part", F.col("places").alias("sends"))


def _divide(places: Column, need: Column, shards: int, seed: int, level: int) -> Column:
    """The places that the lower half's ``need`` rows take: drawn from the shards one after the other."""
    pool = F.aggregate(places, F.lit(0).cast("bigint"), lambda a, b: a + b)
    start = F.struct(need.cast("bigint").alias("need"), pool.alias("pool"), F.array().cast("array<bigint>").alias("got"))

    def one_shard(d: Column, j: Column) -> Column:
        place = F.get(places, j)
        got = hypergeometric(d["pool"], place, d["need"], _uniform(F.lit(seed), F.lit(level), F.col("node"), j))
        return _let(got, lambda g: F.struct((d["need"] - g).alias("need"), (d["pool"] - place).alias("pool"), F.concat(d["got"], F.array(g)).alias("got")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(shards - 1)), start, one_shard, lambda d: d["got"])


def shuffle_into_shards(df: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """(row, shard, slot): a uniform random arrangement, shard sizes at most one apart.

    ``row`` is a struct of all input columns, so no name can clash; every input row, null or
    repeated ones included, comes out once. Slots count from 0 in each shard, without gaps.
    An empty table gives an empty result. The rows are stored first with their numbers, which
    fixes the partitions that the matrix is drawn for; what is sorted is numbers, and the rows
    themselves are exchanged once. The input must have a column.
    """
    number = F.monotonically_increasing_id()
    stored = materialise(df.select(F.struct("*").alias("row"), number.alias("no")), "to-shard")
    numbers = stored.select("no", F.shiftright("no", 33).alias("part"))
    matrix = materialise(communication_matrix(numbers.groupBy("part").agg(F.count("*").alias("n")), shards, seed), "matrix")

    # Permute locally, and cut at the matrix row.
    local = Window.partitionBy("part").orderBy(F.xxhash64(F.lit(seed), F.lit("local"), "no"), "no")
    ends = F.transform(F.sequence(F.lit(1), F.lit(shards)), lambda j: F.aggregate(F.slice("sends", F.lit(1), j), F.lit(0).cast("bigint"), lambda a, b: a + b))
    cut = matrix.select(F.col("part").alias("of"), ends.alias("ends"))
    sent = (
        numbers.withColumn("place", F.row_number().over(local).cast("bigint"))
        .join(cut, F.col("part") == F.col("of"))
        .select("no", F.size(F.filter("ends", lambda end: end < F.col("place"))).alias("shard"))
    )

    # Permute again: a shard's order is that of a random number, whose leading bits cut it into pieces.
    largest = matrix.select(F.aggregate("sends", F.lit(0).cast("bigint"), lambda a, b: a + b).alias("n")).agg(F.sum("n")).first()[0] or 0
    pieces = max(16, math.ceil(largest / shards / ROWS_PER_PIECE))
    drawn = sent.withColumn("draw", _uniform(F.lit(seed), F.lit("shard"), "no"))
    placed = materialise(drawn.withColumn("piece", F.least(F.floor(F.col("draw") * pieces), F.lit(pieces - 1)).cast("bigint")), "placed")
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("shard", "piece").agg(F.count("*").alias("n"))
        .select(F.col("shard").alias("s"), F.col("piece").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    )
    within = Window.partitionBy("shard", "piece").orderBy("draw", "no")
    slots = (
        placed.withColumn("at", F.row_number().over(within) - 1)
        .join(offsets, (F.col("shard") == F.col("s")) & (F.col("piece") == F.col("p")))
        .select(F.col("no").alias("of"), "shard", (F.col("at") + F.col("first")).cast("bigint").alias("slot"))
    )
    return stored.join(slots, F.col("no") == F.col("of")).select("row", "shard", "slot")
