"""Approximate nearest neighbours along shifted space-filling curves.

Nearness is the largest inner product.  Vectors get one component more, so that all have the
norm of the longest: the largest inner product is then the smallest angle.  For each curve the
vectors are projected on a few random directions, shifted by a random offset, and ordered by
their place on a Hilbert curve; Spark range-partitions that order.  A query looks at the rows
within a window of places on each curve, and keeps the best by the exact inner product; the
curves' finds are merged.

The window is measured, not guessed: for `SAMPLE` queries the true neighbours are found by
brute force, and the distance in places at which the nearest curve has them is noted.  The
window is the `RECALL` quantile of those distances, for the number of curves that makes
curves x window least.  Spread-out vectors without clusters have long windows; where a window
would be half of the rows, a single pass over everything is what the measure asks for.

Defined cases: see `vectors.usable`; zero vectors take no part either; a table without usable
vectors gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratebook.llm.chat import placed
from ratebook.llm.common import batch_of, prepare, stored
from ratebook.llm.vectors import best, few_copies, matrix, usable

NEIGHBOURS = 20
CURVES = 4
#: Directions of a curve and bits of each: a place on the curve has 60 bits.
DIRECTIONS = 10
BITS = 6
SAMPLE = 100
RECALL = 0.97
#: Places of a block of rows, at least and at most, and of a block of queries.
BLOCK = (4096, 65536)
QUERY_BLOCK = 1 << 16
#: Products held at once.
CELLS = 2_000_000


def hilbert_places(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of rows of cell coordinates.

    From the top bit down, the lower bits of the first axis are inverted, or exchanged with
    those of the axis at hand, as the cell's corner says; a Gray code of what results is the
    place.
    """
    x = cells.astype(np.uint64).T.copy()
    n = len(x)
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        below = np.uint64((1 << level) - 1)
        for axis in range(n):
            high = (x[axis] >> np.uint64(level)) & one == one
            swap = np.where(high, 0, (x[0] ^ x[axis]) & below).astype(np.uint64)
            x[0] ^= np.where(high, below, swap).astype(np.uint64)
            if axis:
                x[axis] ^= swap
    for axis in range(1, n):
        x[axis] ^= x[axis - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        high = (x[n - 1] >> np.uint64(level)) & one == one
        turn ^= np.where(high, np.uint64((1 << level) - 1), np.uint64(0))
    x ^= turn
    place = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in range(n):
            place = (place << one) | ((x[axis] >> np.uint64(level)) & one)
    return place.astype(np.int64)


def directions(curve: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A curve's random directions (orthogonal where there are enough axes), and its shift."""
    rng = np.random.default_rng(100 + curve)
    count = min(DIRECTIONS, size)
    basis, _ = np.linalg.qr(rng.normal(size=(size, count)))
    return basis, rng.uniform(0, 1, count)


_PLACED = pa.schema(
    [("curve", pa.int32()), ("key", pa.int64()), ("query", pa.bool_()), ("vec_id", pa.int64()),
     ("v", pa.list_(pa.float64()))]
)


def _keys(longest: float, curves: int, every: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            v, ids = matrix(batch.column("v")), batch.column("vec_id").to_numpy()
            norms = np.sqrt((v * v).sum(axis=1))
            rest = np.sqrt(np.maximum(longest**2 - norms**2, 0))
            data = np.column_stack((v, rest)) / longest
            asked = np.column_stack((v / norms[:, None], np.zeros(len(v))))
            rows = np.flatnonzero(np.asarray(batch.column("row")))
            queries = np.flatnonzero(ids % every == 0)
            for curve in range(curves):
                basis, shift = directions(curve, data.shape[1])
                # projections of unit vectors concentrate around zero, by 1 / sqrt(size)
                scale = np.sqrt(data.shape[1]) / 5
                for points, at, query in ((data, rows, False), (asked, queries, True)):
                    cells = (points[at] @ basis) * scale / 2 + 0.5
                    cells = (cells * 0.75 + shift * 0.25).clip(0, 1 - 1e-9) * (1 << BITS)
                    taken = batch.take(pa.array(at))
                    yield batch_of(
                        _PLACED,
                        curve=np.full(len(at), curve),
                        key=hilbert_places(cells.astype(np.int64), BITS),
                        query=np.full(len(at), query),
                        vec_id=taken.column("vec_id"),
                        v=taken.column("v").cast(pa.list_(pa.float64())),
                    )

    return run


def top(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int,
    places: tuple[np.ndarray, np.ndarray] | None = None, window: int = 0,
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query, row, score) of each query's k best rows, of those whose places are at most
    `window` away if places are given.

    The product of matrices only preselects, with a margin: scores are summed the same way
    for every pair, so equal vectors have equal scores.
    """
    step = max(1, CELLS // max(1, len(rows)))
    for low in range(0, len(queries), step):
        part = slice(low, low + step)
        rough = queries[part] @ rows.T
        rough[query_ids[part, None] == ids[None, :]] = -np.inf
        if places is not None:
            rough[np.abs(places[0][part, None] - places[1][None, :]) > window] = -np.inf
        count = min(k, rough.shape[1])
        least = -np.partition(-rough, count - 1, axis=1)[:, count - 1]
        margin = 1e-9 * np.maximum(1, np.abs(np.where(np.isfinite(least), least, 0)))
        q, r = np.nonzero((rough >= (least - margin)[:, None]) & np.isfinite(rough))
        score = (queries[part][q] * rows[r]).sum(axis=1)
        order = np.lexsort((ids[r], -score, q))
        q, r, score = q[order], r[order], score[order]
        begin = np.searchsorted(q, q)
        good = np.arange(len(q)) - begin < k
        yield query_ids[part][q[good]], ids[r[good]], score[good]


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
_FOUND_COLUMNS = "query_id long, vec_id long, score double"


def _against(query_ids: np.ndarray, queries: np.ndarray, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                ids, rows = batch.column("vec_id").to_numpy(), matrix(batch.column("v"))
                for q, r, score in top(query_ids, queries, ids, rows, k):
                    yield batch_of(_FOUND, query_id=q, vec_id=r, score=score)

    return run


def brute_force(rows: DataFrame, queries: list, k: int) -> DataFrame:
    """The best rows of a bounded list of queries, from all rows."""
    ids = np.array([r.vec_id for r in queries], np.int64)
    vectors = np.array([r.v for r in queries], np.float64)
    return best(rows.mapInArrow(_against(ids, vectors, k), _FOUND_COLUMNS), k)


def measured_window(along: DataFrame, rows: DataFrame, k: int, recall: float) -> tuple[int, int]:
    """(curves, window) that find the wanted share of a sample's true neighbours."""
    asked = along.where("query and curve = 0")
    sample = asked.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    truth = brute_force(rows, sample, k).select("query_id", "vec_id")
    places = along.select("curve", "query", "vec_id", "place")
    gaps = (
        truth.join(
            places.where("not query").select("curve", "vec_id", F.col("place").alias("there")),
            "vec_id",
        )
        .join(
            places.where("query").select(
                "curve", F.col("vec_id").alias("query_id"), F.col("place").alias("here")
            ),
            ["curve", "query_id"],
        )
        .select("query_id", "vec_id", "curve", F.abs(F.col("here") - F.col("there")).alias("gap"))
        .collect()
    )
    table: dict[tuple[int, int], dict[int, int]] = {}
    for g in gaps:
        table.setdefault((g.query_id, g.vec_id), {})[g.curve] = g.gap
    if not table:
        return 1, 1
    wide = np.array([[t[c] for c in sorted(t)] for t in table.values()])
    nearest = np.minimum.accumulate(wide, axis=1)
    windows = [int(np.quantile(nearest[:, c], recall)) + 1 for c in range(wide.shape[1])]
    count = min(range(min(2, len(windows)), len(windows) + 1), key=lambda c: c * windows[c - 1])
    return count, windows[count - 1]


def _rerank(window: int, k: int):
    def run(key, left, right):
        rows, queries = left, right
        if not len(rows) or not len(queries):
            return batch_table([])
        places = queries.column("place").to_numpy(), rows.column("place").to_numpy()
        found = top(
            queries.column("vec_id").to_numpy(), matrix(queries.column("v")),
            rows.column("vec_id").to_numpy(), matrix(rows.column("v")), k, places, window,
        )
        return batch_table(
            [batch_of(_FOUND, query_id=q, vec_id=r, score=s) for q, r, s in found]
        )

    return run


def batch_table(batches: list[pa.RecordBatch]) -> pa.Table:
    return pa.Table.from_batches(batches, schema=_FOUND)


def search(
    table: DataFrame,
    every: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = NEIGHBOURS,
    curves: int = CURVES,
    recall: float = RECALL,
) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest rows of each row whose id `every` divides."""
    prepare(table.sparkSession)
    rows = usable(table, id_col, vector_col, nonzero=True)
    rows = stored(rows, "vectors")
    longest = rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()[0]
    if longest is None:
        return rows.select(
            F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id",
            F.lit(0.0).alias("score"),
        ).limit(0)
    # every row can be a query; only the first copies of a vector can be found
    found_rows = few_copies(rows, k + 1).withColumn("row", F.lit(True))
    only_asked = rows.where(F.col("vec_id") % every == 0).withColumn("row", F.lit(False))
    marked = (
        found_rows.unionByName(only_asked)
        .groupBy("vec_id")
        .agg(F.first("v").alias("v"), F.max("row").alias("row"))
    )
    along = placed(
        marked.mapInArrow(
            _keys(float(np.sqrt(longest)), curves, every),
            "curve int, key long, query boolean, vec_id long, v array<double>",
        ),
        "curve",
        [F.col("key"), F.col("query"), F.col("vec_id")],
    )
    along = stored(along, "curves")
    data = along.where("curve = 0 and not query").select("vec_id", "v")
    count, window = measured_window(along, data, k, recall)
    block = int(np.clip(window, *BLOCK))
    along = along.where(F.col("curve") < count)
    block_of = F.floor(F.col("place") / F.lit(block))
    query_block = F.floor(F.col("place") / F.lit(QUERY_BLOCK))
    reach = lambda edge, size: F.floor(F.greatest(edge, F.lit(0)) / F.lit(size))
    data = along.where("not query").withColumn("block", block_of).withColumn(
        "ask",
        F.explode(
            F.sequence(
                reach(F.col("block") * block - window, QUERY_BLOCK),
                reach((F.col("block") + 1) * block + window, QUERY_BLOCK),
            )
        ),
    )
    asked = along.where("query").withColumn("ask", query_block).withColumn(
        "block",
        F.explode(
            F.sequence(reach(F.col("place") - window, block), reach(F.col("place") + window, block))
        ),
    )
    columns = ["curve", "block", "ask", "place", "vec_id", "v"]
    keys = ["curve", "block", "ask"]
    found = (
        data.select(columns)
        .groupBy(*keys)
        .cogroup(asked.select(columns).groupBy(*keys))
        .applyInArrow(_rerank(window, k), _FOUND_COLUMNS)
    )
    return best(found, k)
