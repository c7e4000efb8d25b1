"""Whitening of embeddings by their leading principal components.

Three passes over the vectors, each of which leaves a few numbers a partition: counts and sums;
products of centred vectors; then the projections, row by row.  The covariance matrix, d x d
whatever the number of vectors, is the only thing that reaches the driver, where
`spectrum.leading` slices its spectrum.

Components enter as integers, x = floor(SCALE * c) + OFFSET, so sums are exact.  For the
covariance, vectors are centred at the integers nearest to the means before they are
multiplied, and what is left of the means is taken off after it.  The products are integers too:
as long as their sums stay below 2^53, the matrix doesn't depend on how tasks were cut, or on
which were run again.

Defined cases: a vector that is null, empty or holds a null or non-finite component, one at or
beyond +-LARGEST, or one of another length than most (on a tie the longer) takes no part.
Repeated rows, repeated ids and null ids all take part.  A component whose eigenvalue rounding
cannot tell from zero is left out, so equal vectors, or a single one, give no rows.  A deviation
beyond 38 digits is null.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratebook.llm.common import batch_of, prepare, stored
from ratebook.llm.spectrum import leading
from ratebook.llm.vectors import finite, matrix

SCALE = 1024
OFFSET = 100_000
LARGEST = 2.0**30
COMPONENTS = 8

_SUMS = pa.schema([("d", pa.int32()), ("n", pa.int64()), ("at", pa.int32()), ("s", pa.int64())])
_PRODUCTS = pa.schema([("i", pa.int32()), ("row", pa.list_(pa.float64()))])
_WHITE = pa.schema(
    [("vec_id", pa.int64()), ("deviation", pa.decimal128(38, 0)),
     ("whitened", pa.list_(pa.float64()))]
)
_MOST = 10**38


def integers(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x) of the vectors that can take part."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    rows = table.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), vector.alias("v"))
    small = F.forall("v", lambda c: F.abs(c) < LARGEST)
    return rows.where(finite(F.col("v"))).where(small).select(
        "vec_id", F.transform("v", lambda c: F.floor(c * SCALE) + OFFSET).alias("x")
    )


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """The vectors of a batch, by length."""
    column = batch.column("x")
    lengths = np.asarray(column.value_lengths())
    for d in np.unique(lengths):
        yield int(d), matrix(column.filter(pa.array(lengths == d)))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, tuple[int, np.ndarray]] = {}
    for batch in batches:
        for d, x in _by_length(batch):
            n, s = found.get(d, (0, np.zeros(d, np.int64)))
            found[d] = (n + len(x), s + x.sum(axis=0))
    for d, (n, s) in found.items():
        yield batch_of(_SUMS, d=[d] * d, n=[n] * d, at=np.arange(d), s=s)


def _products(d: int, centre: np.ndarray):
    """Sums of products of vectors less `centre`: row i of the matrix, from the diagonal on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        seen = False
        for batch in batches:
            for length, x in _by_length(batch):
                if length == d:
                    y = (x - centre).astype(float)
                    total += y.T @ y
                    seen = True
        if seen:
            rows = [total[i, i:] for i in range(d)]
            yield batch_of(_PRODUCTS, i=np.arange(d), row=rows)

    return run


@dataclass
class Whitening:
    """What the fit found: `values` and `vectors` hold the components, in falling order."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def centre(self) -> np.ndarray:
        """The integers nearest to the means."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)

    @property
    def rests(self) -> list[int]:
        """n times what is left of the means."""
        return [s - self.n * int(c) for s, c in zip(self.sums, self.centre)]

    @property
    def explained(self) -> list[float]:
        return [float(v / self.trace) for v in self.values]

    def apply(self, vectors: DataFrame) -> DataFrame:
        """(vec_id, deviation, whitened): deviation is n^2 times the squared distance from the
        mean, exact; `whitened` has one number a component."""
        d, n = len(self.sums), self.n
        centre, rests = self.centre, np.array(self.rests, np.int64)
        projection = (self.vectors / np.sqrt(self.values)[:, None]).T

        def deviations(y: np.ndarray) -> list[Decimal | None]:
            bound = n * (int(np.abs(y).max(initial=0)) + 1)
            z = n * y.astype(np.int64 if bound * bound * d < 2**63 else object) - rests
            exact = (z * z).sum(axis=1).tolist()
            return [Decimal(v) if v < _MOST else None for v in exact]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                column = batch.column("x")
                own = batch.filter(pa.array(np.asarray(column.value_lengths()) == d))
                if len(own):
                    y = matrix(own.column("x")) - centre
                    white = (y - rests / n) @ projection
                    yield batch_of(
                        _WHITE,
                        vec_id=own.column("vec_id").to_pylist(),
                        deviation=deviations(y),
                        whitened=list(white),
                    )

        return vectors.mapInArrow(
            run, "vec_id long, deviation decimal(38,0), whitened array<double>"
        )


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Leading components of all `vectors`, a frame of `integers`."""
    prepare(vectors.sparkSession)
    sums = (
        vectors.select("x")
        .mapInArrow(_sums, "d int, n long, at int, s long")
        .groupBy("d", "at")
        .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(20,0)")).alias("s"))
    )
    sums = stored(sums, "vector-sums")
    commonest = sums.agg(F.max(F.struct("n", "d")).alias("most")).first()["most"]
    kept = sums.where(F.col("d") == commonest["d"]).orderBy("at").collect() if commonest else []
    if not kept:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0)
    found = Whitening(
        kept[0].n, [int(r.s) for r in kept], np.zeros(0), np.zeros((0, len(kept))), 0.0
    )
    d, n = len(kept), found.n
    products = (
        vectors.select("x")
        .mapInArrow(_products(d, found.centre), "i int, row array<double>")
        .select("i", F.posexplode("row").alias("j", "p"))
        .groupBy("i", "j")
        .agg(F.sum("p").alias("p"))
        .collect()
    )
    upper = np.zeros((d, d))
    for r in products:
        upper[r.i, r.i + r.j] = r.p
    rest = np.array([r / n for r in found.rests])
    covariance = (upper + np.triu(upper, 1).T) / n - np.outer(rest, rest)
    pairs = leading(covariance, components)
    found.values, found.vectors = pairs.values, pairs.vectors
    found.trace = float(np.trace(covariance))
    return found


def identity_error(white: DataFrame, components: int) -> float:
    """Largest absolute entry of the covariance of `whitened` less the identity."""
    if not components:
        return 0.0
    at: list[Column] = [F.col("whitened")[k] for k in range(components)]
    entries = [
        F.abs(F.covar_pop(at[i], at[j]) - float(i == j))
        for i in range(components)
        for j in range(i, components)
    ]
    worst = white.agg(F.greatest(*entries) if len(entries) > 1 else entries[0]).first()[0]
    return float(worst)


def whiten(
    table: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """One row a vector and component: vec_id, component, n, deviation, whitened, explained,
    identity_error."""
    vectors = integers(table, id_col, vector_col)
    found = fit(vectors, components)
    k = len(found.values)
    white = stored(found.apply(vectors), "whitened")
    error = identity_error(white, k)
    explained = F.array(*(F.lit(e) for e in found.explained)).cast("array<double>")
    return white.select(
        "vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")
    ).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(found.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained[F.col("at")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )
