import duckdb
import numpy as np
import pytest

from ratebook.llm import hilbert, pivots

COLUMNS = "vec_id long, embedding array<float>, label int, v int, place int, query string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2, "q") for i, v in rows], COLUMNS).repartition(3)


def unusable():
    nan, inf = float("nan"), float("inf")
    return [
        (100_000, None), (100_020, [nan] * 8), (100_040, [1.0, None] + [0.0] * 6),
        (100_060, [inf] + [1.0] * 7), (100_080, []), (100_100, [1.0, 2.0]), (None, [1.0] * 8),
    ]


def vectors(count=500, size=8, seed=1):
    rng = np.random.default_rng(seed)
    made = rng.normal(size=(count, size)).astype(np.float32)
    made[50:120] = made[50]  # one common vector
    made[140] *= 40  # lengths differ
    return [(i, v.tolist()) for i, v in enumerate(made)]


def test_hilbert_neighbours_are_neighbours():
    """Consecutive places are cells that touch, and every cell has one place."""
    for axes, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes), -1).reshape(-1, axes)
        places = hilbert.hilbert_places(cells, bits)
        assert sorted(places.tolist()) == list(range(len(cells)))
        walk = cells[np.argsort(places)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("blocks", [(8, 16), hilbert.BLOCK])
def test_nearest_neighbours(spark, monkeypatch, blocks):
    monkeypatch.setattr(hilbert, "BLOCK", blocks)
    monkeypatch.setattr(hilbert, "QUERY_BLOCK", 128)
    rows = vectors()
    rows_and_more = rows + unusable() + [(500, [0.0] * 8), rows[3], (3, [9e9] * 8)]
    found = hilbert.search(table(spark, rows_and_more), every=20, k=5).collect()
    ids, m = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float64)
    assert {r.query_id for r in found} == set(range(0, 500, 20))
    hits = total = 0
    for q in range(0, 500, 20):
        scores = (m @ m[q]).tolist()
        truth = sorted((-s, i) for i, s in zip(ids, scores) if i != q)[:5]
        own = sorted((r for r in found if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == [1, 2, 3, 4, 5] and q not in {r.vec_id for r in own}
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        for r in own:
            assert r.score == pytest.approx(float(m[r.vec_id] @ m[q]), rel=1e-12)
        hits += len({r.vec_id for r in own} & {i for _, i in truth})
        total += 5
    assert hits / total >= 0.9


def brute_force(rows, every, k):
    whole = {i: [int(np.floor(256 * float(x))) for x in v] for i, v in rows}
    out = []
    for q in sorted(whole):
        if q % every == 0:
            scores = sorted(
                (-sum(a * b for a, b in zip(whole[q], whole[c])), c) for c in whole if c != q
            )
            out += [(q, n, c, -s) for n, (s, c) in enumerate(scores[:k], 1)]
    return out


def test_pivot_search(spark, monkeypatch):
    monkeypatch.setattr(pivots, "ROW_BLOCK", 100)
    monkeypatch.setattr(pivots, "QUERY_BLOCK", 6)
    rows = vectors() + [(500, [0.0] * 8), (600, [-1e-30] * 8)]
    found = pivots.search(table(spark, rows + unusable() + [rows[7]]), every=50)
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect()) == brute_force(rows, 50, 5)


def test_pivot_search_agrees_with_sql(spark):
    rows = vectors(150) + [r for r in unusable()[:5]]
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    theirs = con.execute(pivots.SQL).fetchall()
    ours = pivots.search(table(spark, rows), every=50).collect()
    assert sorted(theirs) == sorted(map(tuple, ours))


def test_elimination_stops_early():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 16)) * 1000
    rows = np.floor(np.repeat(centres, 100, axis=0) + rng.normal(size=(2000, 16)) * 5)
    p = centres[:8]
    d = pivots.distances(rows, p)
    found, seen = pivots.eliminate(
        0, rows[0], d[0], np.arange(2000), rows, d, (rows**2).sum(axis=1), -np.inf, 5
    )
    scores = rows @ rows[0]
    truth = sorted((-int(s), i) for i, s in enumerate(scores) if i)[:5]
    assert [(-s, i) for s, i in found] == truth and seen < 1000


def test_large_components(spark):
    rows = [(0, [3e38, -3e38]), (50, [3e38, 1.0]), (1, [1.0, 1.0])]
    found = pivots.search(table(spark, rows), every=50).collect()
    assert {(r.query_id, r.vec_id, r.score) for r in found if r.query_id == 0} == {
        (0, 50, (1 << 63) - 1), (0, 1, 0)
    }


def test_empty_and_small_tables(spark):
    for rows in ([], unusable(), [(0, [1.0, 2.0])]):
        assert hilbert.search(table(spark, rows), every=20).count() <= len(rows)
        assert pivots.search(table(spark, rows), every=50).count() <= len(rows)
    assert hilbert.search(table(spark, [(0, [1.0]), (1, [2.0])]), every=20).collect()[0].vec_id == 1
