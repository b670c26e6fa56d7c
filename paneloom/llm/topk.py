"""Exact top-k inner products by block-at-a-time pruning.

Vectors are put into an order that keeps like ones together, by halving at the median of the dimension
that varies most, and cut into blocks of consecutive rows. A block keeps every dimension's largest and
smallest component, its centre and radius, and its vectors as a forward index. For a query, the sum over dimensions of
what the block could contribute at most bounds all its scores, and so does the centre's score plus the radius times the
query's length; blocks are scored in the order of falling bounds until the bound of the next lies below the
k-th score found.

Queries and blocks meet on a grid of cells, each of a bounded number of both, so that neither
side is broadcast or collected; a query's best of every cell are merged at the end.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneloom.store import materialise

BLOCK = 64
#: Rows and queries of a cell.
CELL_ROWS = 8192
CELL_QUERIES = 1024
#: Norms up to which products are exact in doubles, and fit into 64 bits.
EXACT, LONGEST = 2.0**26, 2.0**31


def quantized(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) per component; null for a vector that is null, empty or holds null, NaN or infinity, or a component
    beyond the integers of LONGEST."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(LONGEST / scale)))
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))
    return F.when(sound & (F.size(vector) > 0), whole)


def top_k(rows: DataFrame, queries: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of every query row.

    ``queries`` is a condition on the rows; candidates are all rows but the query's own, so rows
    that repeat an id are no candidates of it. Rows that repeat an id are candidates of others as often as they are
    there, and as queries they ask together: the k best of all their pairs. Equal scores go by smaller id. Vectors that hold
    null, NaN or infinite components take no part, and vectors of different lengths do not meet.
    Rows with a null id take no part. Fewer candidates than k give fewer rows, none gives none.
    Products are summed in doubles, which is exact while norms stay below 2**26, and in 64-bit integers in cells with a
    longer vector; from a norm of 2**31 on a score would not be a 64-bit integer, and the vector takes no part.
    """
    code = quantized(F.col(vector), scale)
    norm = F.sqrt(F.aggregate("code", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    safe = F.when(norm < LONGEST, F.col("code"))
    sound = (
        rows.select(F.col(vec_id).cast("bigint").alias("id"), code.alias("code"), F.coalesce(queries, F.lit(False)).alias("asks"))
        .where("id is not null and code is not null")
        .select("id", safe.alias("code"), "asks", F.size("code").alias("dim"), F.monotonically_increasing_id().alias("no"))
        .where("code is not null")
    )
    stored = materialise(sound, "vectors")
    counts = stored.agg(F.count("*"), F.count_if("asks")).first()
    n_rows, n_queries = max(1, -(-counts[0] // CELL_ROWS)), max(1, -(-counts[1] // CELL_QUERIES))
    deal = lambda n: F.pmod(F.xxhash64("no"), F.lit(n)).cast("int")
    spread = lambda n, own, other: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda j: F.struct(*(x.alias(y) for x, y in ((own(j), "r"), (other(j), "q")))))
    candidate = stored.withColumn("own", deal(n_rows)).withColumn("cells", spread(n_queries, lambda _j: F.col("own"), lambda j: j))
    asking = stored.where("asks").withColumn("own", deal(n_queries)).withColumn("cells", spread(n_rows, lambda j: j, lambda _j: F.col("own")))
    columns = ["dim", "cell.r", "cell.q", "id", "code", "is_query"]
    both = (
        candidate.withColumn("is_query", F.lit(False))
        .unionByName(asking.withColumn("is_query", F.lit(True)))
        .withColumn("cell", F.explode("cells"))
        .select(*columns)
    )

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        asks = pdf["is_query"].to_numpy()
        found, _ = search_cell(pdf[~asks], pdf[asks], k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    # A query's rows are few in a cell, so the merge sorts cells x k rows per query.
    best = both.groupBy("dim", "r", "q").applyInPandas(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def in_blocks(vectors: np.ndarray) -> np.ndarray:
    """An order of the rows in which blocks hold like vectors; every half but the last is a whole number of blocks."""
    ranges, out = [np.arange(len(vectors))], []
    while ranges:
        rows = ranges.pop()
        if len(rows) <= BLOCK:
            out.append(rows)
            continue
        half = -(-len(rows) // (2 * BLOCK)) * BLOCK
        axis = int(vectors[rows].var(axis=0).argmax())
        rows = rows[np.argpartition(vectors[rows, axis], half - 1)] if half < len(rows) else rows
        ranges += [rows[half:], rows[:half]]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def search_cell(rows: pd.DataFrame, queries: pd.DataFrame, k: int) -> tuple[list[tuple[int, int, int]], float]:
    """The k best of the cell's rows for each of its queries, and the share of blocks that were scored."""
    if not len(rows) or not len(queries):
        return [], 0.0
    forward = np.stack(rows["code"].to_numpy()).astype(np.float64)
    order = in_blocks(forward)
    rows, forward = rows.iloc[order], forward[order]
    ids = rows["id"].to_numpy()
    asked = np.stack(queries["code"].to_numpy()).astype(np.float64)
    longest = max((x * x).sum(1).max() for x in (forward, asked)) ** 0.5
    # Scores are exact: in doubles if they all stay below 2**53, else in 64-bit integers, with room for the bounds' rounding.
    exact = (forward, asked) if longest < EXACT else tuple(np.stack(x["code"].to_numpy()).astype(np.int64) for x in (rows, queries))
    room = 0.0 if longest < EXACT else longest * longest * 1e-9
    edges = np.arange(0, len(ids), BLOCK)
    high, low = np.maximum.reduceat(forward, edges), np.minimum.reduceat(forward, edges)
    # A term's maximum is the high component where the query's is positive, the low one where negative.
    boxes = np.maximum(asked, 0) @ high.T + np.minimum(asked, 0) @ low.T
    sizes = np.diff(np.append(edges, len(ids)))
    centre = np.add.reduceat(forward, edges) / sizes[:, None]
    radius = np.sqrt(np.maximum.reduceat(((forward - np.repeat(centre, sizes, axis=0)) ** 2).sum(1), edges))
    length = np.sqrt((asked * asked).sum(1))
    balls = asked @ centre.T + length[:, None] * radius
    # The centres are rounded, scores are not: a little room keeps the bounds above.
    bounds = np.minimum(boxes, balls + 1e-9 * (length[:, None] * (radius + np.sqrt((centre * centre).sum(1)))) + 1e-6) + room
    forward, out, scored = exact[0], [], 0
    for query, vector, bound in zip(queries["id"].to_numpy(), exact[1], bounds, strict=True):
        best_score, best_id = np.zeros(0, forward.dtype), np.zeros(0, np.int64)
        for block in np.argsort(-bound, kind="stable"):
            if len(best_score) >= k and bound[block] < best_score[k - 1]:
                break
            scored += 1
            part = slice(edges[block], edges[block] + BLOCK)
            score, name = forward[part] @ vector, ids[part]
            other = name != query
            if len(best_score) >= k:
                other &= score >= best_score[k - 1]
            if other.any():
                best_score, best_id = np.concatenate([best_score, score[other]]), np.concatenate([best_id, name[other]])
                order = np.lexsort((best_id, -best_score))[:k]
                best_score, best_id = best_score[order], best_id[order]
        out.extend((query, i, s) for i, s in zip(best_id, best_score, strict=True))
    return out, scored / bounds.size
