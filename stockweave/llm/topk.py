"""Exact top-k by inner product, with multi-resolution statistics of segments.

A vector is cut into segments, each described by its mean m and the length d of what deviates
from it. The part of an inner product that a segment contributes is at most
n * m * m' + d * d' (n components each), so the sum over segments bounds the score from above,
which is the same as bounding the distance |q - x|^2 = |q|^2 + |x|^2 - 2 q.x from below. Bounds
are taken with one segment first, then with 2, 4, ..., and only where the one before could
still beat the query's k-th best score so far. Survivors get their exact score.

Queries and candidates meet in blocks: each block of candidates is searched for each block of
queries in a task of its own, which returns at most k rows per query; the best k of those are
the result. Components are whole numbers (`floor(scale * x)`), so scores are exact.

Rows with a null vector, or a null or non-finite component, take no part, nor do empty vectors.
All others do: rows that repeat a vec_id are candidates, and queries, of their own, and a
null vec_id comes after all others. Queries meet candidates of their own length only. Ties go to the
smaller vec_id. Vectors with components too large for exact floating point products are
scored in Python integers; a score beyond a long is the nearest long. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockweave.durable import durable

K = 20
QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 16384
_STEP = 512  # candidates bounded at once


_EXACT = 1 << 20  # products of smaller whole numbers have exact sums in floating point
_WIDEST = 2.0**1000  # stands for what is beyond the range of a double
_LONG = (1 << 63) - 1


def whole_vectors(
    vectors: DataFrame, scale: float = 64.0, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(row, vec_id, v array<double>): v is scale * x, of which the floor counts; row is unique."""
    x = vectors[vector]

    def finite(c: Column) -> Column:
        c = c.cast("double")
        return F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False))

    return durable(
        vectors.filter(x.isNotNull() & (F.size(x) > 0) & F.forall(x, finite)).select(
            # rows without a vec_id have the larger numbers
            (
                F.monotonically_increasing_id()
                + F.when(vectors[vec_id].isNull(), F.lit(1 << 62)).otherwise(F.lit(0))
            ).alias("row"),
            vectors[vec_id].cast("long").alias("vec_id"),
            F.transform(x, lambda c: F.lit(scale) * c.cast("double")).alias("v"),
        ),
        "vectors",
    )


def _resolutions(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per resolution: means times the root of the segment's size, and lengths of deviations."""
    n, dim = x.shape
    out, count = [], 1
    while count <= max(1, dim // 4):
        cuts = np.linspace(0, dim, count + 1).astype(int)
        size = np.diff(cuts)
        total = np.add.reduceat(x, cuts[:-1], axis=1)
        square = np.add.reduceat(x * x, cuts[:-1], axis=1)
        mean = total / np.sqrt(size)
        out.append((mean, np.sqrt(np.maximum(square - mean * mean, 0))))
        count *= 2
    return out


def _large_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Scores of one query against many rows in Python integers, as the nearest long."""
    mine = [int(v) for v in q]
    sums = (sum(a * int(b) for a, b in zip(mine, row, strict=True)) for row in x.tolist())
    return np.array([max(-_LONG - 1, min(_LONG, s)) for s in sums], dtype=np.int64)


def search_block(
    query_rows: np.ndarray,
    queries: np.ndarray,
    rows: np.ndarray,
    names: np.ndarray,
    vectors: np.ndarray,
    k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query position, candidate position, score) of the k best candidates of each query in one
    block, of whole-number vectors. Ties go by `names`, then by row; a row doesn't meet itself."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    large_q = (np.abs(queries) >= _EXACT).any(axis=1)
    large_x = (np.abs(vectors) >= _EXACT).any(axis=1)
    for i in np.flatnonzero(large_q | large_x.any()).tolist():
        some = np.flatnonzero((large_x | large_q[i]) & (rows != query_rows[i]))
        found.append((np.full(len(some), i), some, _large_scores(queries[i], vectors[some])))
    q = np.where(large_q[:, None], 0, queries)
    bounds_q = _resolutions(q)
    # long vectors first: they raise the k-th best score soonest
    plain = np.flatnonzero(~large_x)
    by_length = plain[np.argsort(-np.einsum("ij,ij->i", vectors[plain], vectors[plain]), kind="stable")]
    best = np.full((len(q), k), -np.inf)  # the best scores so far, sorted up
    for at in range(0, len(by_length), _STEP):
        some = by_length[at : at + _STEP]
        x = vectors[some]
        alive = (query_rows[:, None] != rows[some][None, :]) & ~large_q[:, None]
        floor = best[:, :1]
        for (mq, dq), (mx, dx) in zip(bounds_q, _resolutions(x), strict=True):
            if not alive.any():
                break
            above = mq @ mx.T + dq @ dx.T
            alive &= above + 1e-6 * (1 + np.abs(above)) >= floor
        i, j = np.nonzero(alive)
        if not len(i):
            continue
        if len(i) > alive.size // 8:
            scores = (q @ x.T)[i, j].astype(np.int64)
        else:
            scores = np.einsum("ij,ij->i", q[i], x[j]).astype(np.int64)
        good = scores >= floor[i, 0]
        i, j, scores = i[good], j[good], scores[good]
        found.append((i, some[j], scores))
        grid = np.full(alive.shape, -np.inf)
        grid[i, j] = scores
        both = np.concatenate([best, grid], axis=1)
        best = np.sort(np.partition(both, both.shape[1] - k, axis=1)[:, -k:], axis=1)
    if not found:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty
    i, j, scores = (np.concatenate(c) for c in zip(*found, strict=True))
    good = scores >= best[i, 0]
    i, j, scores = i[good], j[good], scores[good]
    order = np.lexsort((rows[j], names[j], ~scores, i))  # ~ turns the order without overflow
    i, j, scores = i[order], j[order], scores[order]
    place = np.arange(len(i)) - np.searchsorted(i, i)
    return i[place < k], j[place < k], scores[place < k]


def _blocks(vectors: DataFrame, rows: int, per_block: int, name: str) -> DataFrame:
    """(dim, name, rows, names, values): vectors dealt to blocks of about `per_block` rows."""
    count = max(1, math.ceil(rows / per_block))
    one = F.struct("row", F.coalesce("vec_id", F.lit(_LONG)).alias("name"), "v")
    return (
        vectors.groupBy(
            F.size("v").alias("dim"),
            F.pmod(F.xxhash64("row"), F.lit(count)).cast("int").alias(name),
        )
        .agg(F.collect_list(one).alias("held"))
        .select(
            "dim", name, F.col("held.row").alias("rows"), F.col("held.name").alias("names"),
            F.flatten("held.v").alias("values"),
        )
    )


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = K,
    query_block: int = QUERY_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score); `vectors` is of `whole_vectors`, `queries` some of its rows."""
    n, m = vectors.count(), queries.count()
    q = _blocks(queries, m, query_block, "block").drop("names")
    c = _blocks(vectors, n, candidate_block, "part").withColumnRenamed("dim", "c_dim")
    # every block of candidates goes to every block of queries; their number is known
    numbers = F.sequence(F.lit(0), F.lit(max(1, math.ceil(m / query_block)) - 1))
    c = c.withColumn("c_block", F.explode(numbers)).withColumnsRenamed(
        {"rows": "c_rows", "values": "c_values"}
    )
    pairs = q.join(
        c, (F.col("dim") == F.col("c_dim")) & (F.col("block") == F.col("c_block"))
    ).select("dim", "rows", "values", "c_rows", "names", "c_values")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                dim = batch.column("dim")[i].as_py()
                mine, values, theirs, names, c_values = (
                    batch.column(name)[i].values.to_numpy(zero_copy_only=False)
                    for name in ("rows", "values", "c_rows", "names", "c_values")
                )
                values, c_values = (
                    np.floor(np.clip(v, -_WIDEST, _WIDEST)).reshape(-1, dim)
                    for v in (values, c_values)
                )
                a, b, score = search_block(mine, values, theirs, names, c_values, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mine[a]), pa.array(theirs[b]), pa.array(names[b]), pa.array(score)],
                    ["query", "row", "name", "score"],
                )

    near = pairs.mapInArrow(search, "query long, row long, name long, score long")
    order = W.partitionBy("query").orderBy(F.col("score").desc(), "name", "row")
    best = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    known = queries.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
    # the name of a row without a vec_id can be that of another row
    nameless = vectors.filter(F.col("vec_id").isNull()).select("row", F.lit(True).alias("nameless"))
    return (
        best.join(known, "query")
        .join(nameless, "row", "left")
        .select(
            "query_id", F.col("rank").cast("int").alias("rank"),
            F.when(F.col("nameless").isNull(), F.col("name")).alias("vec_id"), "score",
        )
    )
