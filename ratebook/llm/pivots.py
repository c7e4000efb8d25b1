"""Exact top-k search by pivot elimination.

Vectors are made integer, and the score is the integer inner product.  Distances to `PIVOTS`
pivots are computed once for every row.  For a query q and a row c the triangle inequality
gives |q - c| >= |d(q, p) - d(c, p)| for each pivot p; the largest of those lower bounds turns
into an upper bound of the score, since 2<q, c> = |q|^2 + |c|^2 - |q - c|^2.  A task holds a
block of rows and a block of queries, and evaluates each query's rows in the order of their
bounds until the next bound is below the k-th best score: no later row can be better.  The
k-th best starts from a bounded sample of rows that every query has seen, which only saves
work.

Rows are dealt to blocks by their nearest pivot, a pivot with many rows to several blocks.

Defined cases: see `vectors.usable`; a zero vector takes part; a table without usable vectors
gives no rows; scores beyond the range of a long are cut to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratebook.llm.common import batch_of, prepare, stored
from ratebook.llm.vectors import best, few_copies, matrix, usable

NEIGHBOURS = 5
SCALE = 256
PIVOTS = 32
#: Rows that every query is compared with first.
SEEDS = 512
ROW_BLOCK = 4096
QUERY_BLOCK = 1024
#: Rows evaluated at once.
STEP = 128

_LONG = (1 << 63) - 1
_MOST = 1.7e308


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of two matrices of whole doubles."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)))
    reach = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if reach < 2**53:
        return a @ b.T  # every partial sum is a whole double
    if reach < 2**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    whole = lambda m: np.array([[int(x) for x in r] for r in m], object)
    return np.clip(whole(a) @ whole(b).T, -_LONG - 1, _LONG)


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (rows**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1)[None, :]
    return np.sqrt(np.maximum(squares - 2 * (rows @ pivots.T), 0))


_TABLE = pa.schema(
    [("vec_id", pa.int64()), ("v", pa.list_(pa.float64())), ("d", pa.list_(pa.float64())),
     ("nearest", pa.int32())]
)


def _pivot_table(pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                d = distances(matrix(batch.column("v")), pivots)
                yield batch_of(
                    _TABLE,
                    vec_id=batch.column("vec_id"),
                    v=batch.column("v"),
                    d=list(d),
                    nearest=d.argmin(axis=1),
                )

    return run


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def eliminate(
    query_id: int, query: np.ndarray, query_d: np.ndarray, ids: np.ndarray, rows: np.ndarray,
    rows_d: np.ndarray, norms: np.ndarray, floor: float, k: int,
) -> tuple[list[tuple[int, int]], int]:
    """(score, id) of the k best rows of at least `floor`, and how many rows were evaluated."""
    lower = np.zeros(len(rows))
    for p in range(rows_d.shape[1]):
        np.maximum(lower, np.abs(rows_d[:, p] - query_d[p]), out=lower)
    own = float((query**2).sum())
    # doubles are rounded: bounds give way by more than that
    slack = 1e-9 * (own + norms + 1)
    bound = (own + norms - lower**2) / 2 + slack
    order = np.argsort(-bound, kind="stable")
    found: list[tuple[int, int]] = []
    seen = 0
    for low in range(0, len(order), STEP):
        if bound[order[low]] < floor:
            break
        part = order[low : low + STEP]
        seen += len(part)
        scores = exact_products(query[None, :], rows[part])[0]
        good = (scores >= floor) & (ids[part] != query_id)
        found += [(int(s), int(i)) for s, i in zip(scores[good], ids[part][good])]
        if len(found) >= k:
            found = sorted(found, key=lambda f: (-f[0], f[1]))[:k]
            floor = max(floor, found[-1][0])
    return sorted(found, key=lambda f: (-f[0], f[1]))[:k], seen


def _search_block(k: int, seed_ids: np.ndarray, seeds: np.ndarray):
    def run(key, left, right):
        if not len(left) or not len(right):
            return pa.Table.from_batches([], schema=_FOUND)
        ids, rows, rows_d = left.column("vec_id").to_numpy(), matrix(left.column("v")), matrix(left.column("d"))
        norms = (rows**2).sum(axis=1)
        asked, queries, queries_d = (
            right.column("vec_id").to_numpy(), matrix(right.column("v")), matrix(right.column("d"))
        )
        known = exact_products(queries, seeds)
        out: list[tuple[int, int, int]] = []
        for n, query_id in enumerate(asked.tolist()):
            others = np.sort(known[n][seed_ids != query_id])
            floor = float(others[-k]) if len(others) >= k else -np.inf
            found, _ = eliminate(
                query_id, queries[n], queries_d[n], ids, rows, rows_d, norms, floor, k
            )
            out += [(query_id, i, s) for s, i in found]
        columns = list(zip(*out)) if out else [[]] * 3
        return pa.Table.from_batches(
            [batch_of(_FOUND, **dict(zip(_FOUND.names, map(list, columns))))]
        )

    return run


def _whole(x: Column) -> Column:
    """The floor, as a double; large doubles are whole, and those beyond all are cut."""
    cut = F.greatest(F.least(x, F.lit(_MOST)), F.lit(-_MOST))
    return F.when(F.abs(cut) < F.lit(2.0**52), F.floor(cut).cast("double")).otherwise(cut)


def search(
    table: DataFrame,
    every: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = NEIGHBOURS,
    scale: int = SCALE,
    pivots: int = PIVOTS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest scores of each row whose id `every` divides."""
    prepare(table.sparkSession)
    rows = usable(table, id_col, vector_col, nonzero=False).select(
        "vec_id", F.transform("v", lambda x: _whole(x * scale)).alias("v")
    )
    rows = stored(rows, "whole-vectors")
    by_hash = rows.orderBy(F.xxhash64("vec_id"), "vec_id")
    seeds = by_hash.limit(SEEDS).collect()
    if not seeds:
        return rows.select(
            F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id",
            F.col("vec_id").alias("score"),
        ).limit(0)
    seed_ids = np.array([r.vec_id for r in seeds], np.int64)
    seed_rows = np.array([r.v for r in seeds], np.float64)
    columns = "vec_id long, v array<double>, d array<double>, nearest int"
    measure = _pivot_table(seed_rows[:pivots])
    measured = stored(few_copies(rows, k + 1).mapInArrow(measure, columns), "pivot-table")
    queries = rows.where(F.col("vec_id") % every == 0).mapInArrow(measure, columns)
    queries = stored(queries, "queries")
    # blocks: as many for a pivot as its rows need
    per_pivot = {r.nearest: r["count"] for r in measured.groupBy("nearest").count().collect()}
    first, numbers = 0, []
    for p in range(max(per_pivot, default=0) + 1):
        blocks = -(-per_pivot.get(p, 0) // ROW_BLOCK)
        numbers.append((first, max(1, blocks)))
        first += blocks
    asked_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    start = F.element_at(F.array(*(F.lit(n[0]) for n in numbers)), F.col("nearest") + 1)
    width = F.element_at(F.array(*(F.lit(n[1]) for n in numbers)), F.col("nearest") + 1)
    data = measured.withColumn("block", start + F.pmod(F.xxhash64("vec_id"), width)).withColumn(
        "ask", F.explode(F.sequence(F.lit(0), F.lit(asked_blocks - 1)))
    )
    asked = queries.withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(max(0, first - 1))))
    ).withColumn("ask", F.pmod(F.xxhash64("vec_id"), F.lit(asked_blocks)))
    columns = ["block", "ask", "vec_id", "v", "d"]
    shape = lambda df: df.select(
        F.col("block").cast("long"), F.col("ask").cast("long"), *columns[2:]
    ).groupBy("block", "ask")
    found = shape(data).cogroup(shape(asked)).applyInArrow(
        _search_block(k, seed_ids, seed_rows), "query_id long, vec_id long, score long"
    )
    return best(found, k)


#: The same rows on a table `embeddings` (vec_id, embedding).
SQL = f"""
WITH whole AS (
  SELECT vec_id, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)]) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
    AS rank
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {NEIGHBOURS}
"""
