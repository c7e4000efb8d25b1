"""Toxicity by a classifier chain.

Categories are predicted one after the other.  Each model is a regularised logistic
regression over the words of a text and over the probabilities of the categories before it;
these come, for training, from models that did not see the text (`FOLDS` folds), so a later
model learns how far it can trust an earlier one.

A text's features are its distinct words and their beginnings of 4 to 6 letters.  Those that
tell the categories apart best (chi-squared) on the training texts are kept: `FEATURES` for
each category.  A model that is to judge a fold chooses its features without that fold, too.  Training reads at most `TRAINING` labelled texts, chosen by a hash of the id;
every text is scored whole.

Defined cases: a null or empty text has no features; a null id is kept; of repeated ids one
text is trained on, and every row is scored; a null label is no label; a category without
positive examples has probability 0, one without negative ones 1.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratebook.llm.common import batch_of, prepare, stored, texts

TRAINING = 8_000
FEATURES = 400
FOLDS = 5
BEGINNINGS = (4, 5, 6)
#: Weight of the penalty on squared coefficients (chosen on held-out texts), and steps of the
#: descent.
RIDGE = 3.0
STEPS = 400
KEPT_CHUNKS = 150_000
#: Counts that a task holds before it hands them on; Spark adds them up.
COUNTED_AT_ONCE = 50_000

_WORD = regex.compile(r"[\p{L}\p{M}]+")


def features_of(chunk: str) -> set[str]:
    """Of a stretch without white space: its words, and where they begin (marked with ^)."""
    found = set()
    for word in _WORD.findall(chunk):
        found.add(word)
        found.update("^" + word[:n] for n in BEGINNINGS if len(word) >= n)
    return found


class _Lookup(dict):
    """Chunk -> places of its known features, worked out once a chunk."""

    def __init__(self, places: dict[str, int]) -> None:
        super().__init__()
        self.places = places

    def __missing__(self, chunk: str) -> tuple[int, ...]:
        if len(self) > KEPT_CHUNKS:
            self.clear()
        found = tuple(self.places[f] for f in features_of(chunk) if f in self.places)
        self[chunk] = found
        return found

    def of(self, text: str) -> list[int]:
        chunks = set(text.lower().split())
        return sorted({p for found in map(self.__getitem__, chunks) if found for p in found})


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


@dataclass
class Table:
    """Texts as the places of their features (0/1), and a few dense columns."""

    found: list[np.ndarray]
    size: int
    dense: np.ndarray

    def __post_init__(self) -> None:
        counts = [len(f) for f in self.found]
        self.rows = np.repeat(np.arange(len(self.found)), counts)
        self.places = np.concatenate([np.zeros(0, np.int64), *self.found]).astype(np.int64)

    def __len__(self) -> int:
        return len(self.found)

    def where(self, chosen: np.ndarray) -> Table:
        at = np.flatnonzero(chosen)
        return Table([self.found[k] for k in at], self.size, self.dense[at])

    def only(self, places: np.ndarray) -> Table:
        """The same texts, with these of their features alone."""
        kept = np.zeros(self.size, bool)
        kept[places] = True
        return Table([f[kept[f]] for f in self.found], self.size, self.dense)

    def beside(self, column: np.ndarray) -> Table:
        return Table(self.found, self.size, np.column_stack((self.dense, column)))

    def scores(self, w: np.ndarray) -> np.ndarray:
        """Sums of coefficients: features, dense columns, intercept."""
        z = np.bincount(self.rows, w[self.places], len(self)) + w[-1]
        return z + self.dense @ w[self.size : -1]

    def slope(self, r: np.ndarray) -> np.ndarray:
        """The transpose: what each coefficient gathers of `r`."""
        own = np.bincount(self.places, r[self.rows], self.size)
        return np.concatenate((own, r @ self.dense, [r.sum()]))


def fit(x: Table, y: np.ndarray, ridge: float = RIDGE, steps: int = STEPS) -> np.ndarray:
    """Coefficients of a ridge logistic regression; the last one is the free intercept.

    Both classes weigh the same in all, so a rare category is not drowned by the rest.
    """
    width = x.size + x.dense.shape[1] + 1
    if not len(y) or y.min() == y.max():
        out = np.zeros(width)
        out[-1] = 35.0 if len(y) and y[0] else -35.0
        return out
    penalty = np.full(width, ridge)
    penalty[-1] = 0
    share = y.mean()
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share))
    # accelerated gradient descent; the bound on the curvature sets the step
    v = np.ones(width)
    for _ in range(12):
        v = x.slope(weight * x.scores(v))
        v /= np.linalg.norm(v)
    step = 1 / (0.25 * float((weight * x.scores(v) ** 2).sum()) + ridge)
    w = last = np.zeros(width)
    for k in range(steps):
        ahead = w + (k / (k + 3)) * (w - last)
        slope = x.slope(weight * (logistic(x.scores(ahead)) - y)) + penalty * ahead
        last, w = w, ahead - step * slope
    return w


@dataclass
class Chain:
    """Fitted models: features, and a row of coefficients for each category."""

    categories: tuple[str, ...]
    features: list[str]
    weights: list[np.ndarray] = field(default_factory=list)

    def probabilities(self, texts_: Iterator[str | None], lookup: _Lookup) -> np.ndarray:
        found = [np.array(lookup.of(t) if t else [], np.int64) for t in texts_]
        out = np.zeros((len(found), 0))
        for w in self.weights:
            scores = Table(found, len(self.features), out).scores(w)
            out = np.column_stack((out, logistic(scores)))
        return out

    def column(self, text: Column) -> Column:
        """The probabilities of a text, in the order of the categories."""
        places = {f: k for k, f in enumerate(self.features)}
        chain = self

        @F.pandas_udf("array<double>")
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            lookup = _Lookup(places)
            for batch in batches:
                yield pd.Series(list(chain.probabilities(batch, lookup)))

        # real types: Spark reads the hints of the function
        score.func.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
        return score(text)


def train_chain(
    x: Table, y: np.ndarray, folds: np.ndarray, chosen: list[np.ndarray] | None = None
) -> list[np.ndarray]:
    """One row of coefficients a category; y has a column a category (nan: no label).

    `chosen` has the features chosen without each fold, and after them those of all texts.
    """
    every = np.arange(x.size)
    chosen = chosen or [every] * (FOLDS + 1)
    weights = []
    for k in range(y.shape[1]):
        known = ~np.isnan(y[:, k])
        weights.append(fit(x.only(chosen[FOLDS]).where(known), y[known, k]))
        if k + 1 < y.shape[1]:
            held = np.zeros(len(x))
            for fold in range(FOLDS):
                own = folds == fold
                seen = x.only(chosen[fold])
                w = fit(seen.where(known & ~own), y[known & ~own, k])
                held[own] = logistic(seen.where(own).scores(w))
            x = x.beside(held)
    return weights


_COUNTS = "feature string, category int, fold int, positive long, negative long"


def _count_features():
    schema = pa.schema(
        [("feature", pa.string()), ("category", pa.int32()), ("fold", pa.int32()),
         ("positive", pa.int64()), ("negative", pa.int64())]
    )

    def counted(counts: Counter) -> pa.RecordBatch:
        keys = sorted({key[:3] for key in counts})
        return batch_of(
            schema,
            feature=[f for f, _, _ in keys],
            category=[k for _, k, _ in keys],
            fold=[fold for _, _, fold in keys],
            positive=[counts[(*key, 1)] for key in keys],
            negative=[counts[(*key, 0)] for key in keys],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("text", "labels", "fold"))
            for text, labels, fold in zip(*columns):
                found = set().union(*map(features_of, set(text.lower().split())))
                for k, label in enumerate(labels):
                    if label is not None:
                        counts.update((f, k, fold, int(label)) for f in found)
                if len(counts) > COUNTED_AT_ONCE:
                    yield counted(counts)
                    counts.clear()
        yield counted(counts)

    return run


def _chosen_features(sample: DataFrame, categories: int, features: int) -> list[set[str]]:
    """The best features without each fold, and after them those of all texts."""
    labels = [F.col("labels")[k] for k in range(categories)]
    seen = {
        r["fold"]: r
        for r in sample.groupBy("fold")
        .agg(
            F.array(*(F.coalesce(F.sum(v), F.lit(0)) for v in labels)).alias("p"),
            F.array(*map(F.count, labels)).alias("n"),
        )
        .collect()
    }
    left_out = [*range(FOLDS), None]

    def share(left: int | None, k: int) -> float:
        rows = [r for fold, r in seen.items() if fold != left]
        return sum(r["p"][k] for r in rows) / max(sum(r["n"][k] for r in rows), 1)

    def without(name: str, left: int | None) -> Column:
        if left is None:
            return F.sum(name)
        return F.sum(F.when(F.col("fold") != left, F.col(name)).otherwise(0))

    sides = [
        F.struct(
            F.lit(FOLDS if left is None else left).alias("left"),
            without("positive", left).alias("p"),
            (without("positive", left) + without("negative", left)).alias("n"),
            F.element_at(
                F.array(*(F.lit(share(left, k)) for k in range(categories))),
                F.col("category") + 1,
            ).alias("share"),
        )
        for left in left_out
    ]
    counts = (
        sample.mapInArrow(_count_features(), _COUNTS)
        .groupBy("feature", "category")
        .agg(F.array(*sides).alias("sides"))
        .select("feature", "category", F.inline("sides"))
        .where("n > 2")
    )
    expected = F.col("n") * F.col("share")
    # chi-squared of the feature's share of positives, up to a factor that all share
    gain = (F.col("p") - expected) ** 2 / F.greatest(F.lit(1e-9), expected)
    best = Window.partitionBy("left", "category").orderBy(F.desc("gain"), "feature")
    rows = (
        counts.withColumn("gain", gain)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= features)
        .select("left", "feature")
        .distinct()
        .collect()
    )
    out: list[set[str]] = [set() for _ in left_out]
    for r in rows:
        out[r["left"]].add(r["feature"])
    return out


def train(
    docs: DataFrame,
    labels: DataFrame,
    categories: dict[str, Column],
    id_col: str = "doc_id",
    text_col: str = "text",
    training: int = TRAINING,
    features: int = FEATURES,
) -> Chain:
    """Fit the chain; `categories` gives each category's 0/1 label from a row of `labels`."""
    prepare(docs.sparkSession)
    names = tuple(categories)
    chosen = (
        labels.select(
            F.col(f"`{id_col}`").cast("long").alias("doc_id"),
            F.array(*(c.cast("int") for c in categories.values())).alias("labels"),
        )
        .where("doc_id is not null and exists(labels, x -> x is not null)")
        .groupBy("doc_id")
        .agg(F.max("labels").alias("labels"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(training)
    )
    sample = stored(
        texts(docs, id_col, text_col)
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.first("labels").alias("labels"))
        .withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int")),
        "labelled-texts",
    )
    chain = Chain(names, [])
    chosen = _chosen_features(sample, len(names), features)
    every = sorted(set().union(*chosen))
    places = {f: k for k, f in enumerate(every)}

    @F.pandas_udf("array<int>")
    def known(text: pd.Series) -> pd.Series:
        lookup = _Lookup(places)
        return pd.Series([lookup.of(t) for t in text])

    known.func.__annotations__ = {"text": pd.Series, "return": pd.Series}
    rows = (
        sample.select("doc_id", "labels", "fold", known("text").alias("found"))
        .orderBy("doc_id")
        .collect()
    )
    found = [np.array(row.found, np.int64) for row in rows]
    x = Table(found, len(places), np.zeros((len(rows), 0)))
    y = np.full((len(rows), len(names)), np.nan)
    for k, row in enumerate(rows):
        y[k] = [np.nan if v is None else v for v in row.labels]
    folds = np.array([row.fold for row in rows], np.int64)
    weights = train_chain(
        x, y, folds, [np.array([places[f] for f in c], np.int64) for c in chosen]
    )
    # features that only a fold chose have no weight in the end
    chain.features = sorted(chosen[FOLDS])
    kept = np.array([places[f] for f in chain.features], np.int64)
    chain.weights = [np.concatenate((w[kept], w[len(every) :])) for w in weights]
    return chain


def scored(
    docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, p_<category>..., <category>...): probabilities, and whether they reach a half."""
    prepare(docs.sparkSession)
    rows = texts(docs, id_col, text_col).select(
        "doc_id", chain.column(F.col("text")).alias("p")
    )
    return rows.select(
        "doc_id",
        *(F.col("p")[k].alias(f"p_{c}") for k, c in enumerate(chain.categories)),
        *((F.col("p")[k] >= 0.5).alias(c) for k, c in enumerate(chain.categories)),
    )
