import random

import numpy as np
from pyspark.sql import functions as F

from ratebook.llm import toxicity
from ratebook.llm.queries import categories

LABELS = "doc_id long, quality int, toxic int, text string"


def test_chain_on_held_out_texts(spark, documents):
    """Toxic texts are all of low quality here, and hold stems of two letters more."""
    rng = random.Random(7)
    plain = [f"word{n:03}" for n in range(200)]
    rows, labels = [], []
    for i in range(600):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 80))]
        low, bad = i % 3 == 0, i % 6 == 0
        if low:
            words.append("junk")
        if bad:
            words.append("nastee" + rng.choice("abcdefgh") * 2)
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(not low), int(bad), "clash"))
    table = spark.createDataFrame(labels[:400] + [(1, None, None, None), (None, 1, 1, "x")], LABELS)
    chain = toxicity.train(documents(rows), table, categories(), training=350)
    found = {r.doc_id: r for r in toxicity.scored(documents(rows), chain).collect()}
    held = [(i, q, t) for i, q, t, _ in labels[400:]]
    assert np.mean([found[i].toxic == bool(t) for i, _, t in held]) > 0.98
    assert np.mean([found[i].low_quality == (not q) for i, q, _ in held]) > 0.98
    # the later model uses the earlier category
    assert chain.weights[1][len(chain.features)] > 0 and len(chain.weights[0]) == len(chain.features) + 1


def test_folds_do_not_see_their_own_labels():
    rng = np.random.default_rng(8)
    found = [np.flatnonzero(rng.integers(0, 2, 120)) for _ in range(200)]
    x = toxicity.Table(found, 120, np.zeros((200, 0)))
    noise = rng.integers(0, 2, (200, 2)).astype(float)
    weights = toxicity.train_chain(x, noise, np.arange(200) % toxicity.FOLDS)
    # in-sample probabilities of noise would look certain, out-of-fold ones do not help
    assert abs(weights[1][120]) < 2


def test_unlabelled_and_odd_tables(spark, documents, odd):
    docs = documents(odd)
    empty = spark.createDataFrame([], LABELS)
    chain = toxicity.train(docs, empty, categories())
    rows = toxicity.scored(docs, chain).collect()
    assert len(rows) == len(odd) and not any(r.toxic for r in rows)
    ones = spark.createDataFrame([(4, 1, 1, None), (6, 1, 1, None)], LABELS)
    chain = toxicity.train(docs, ones, {"toxic": F.col("toxic")})
    assert all(r.toxic for r in toxicity.scored(docs, chain).collect())
    assert toxicity.scored(documents([]), chain).count() == 0
