import numpy as np
import pytest

from ratebook.llm import whitening
from ratebook.llm.queries import QUERIES
from ratebook.llm.spectrum import NotCertified, above, leading

SF = "/root/testdata/sf0.001"
#: Extra columns are named as the operator names its own.
COLUMNS = "vec_id long, embedding array<float>, x int, n string, whitened int, deviation int, d int"


def vectors(spark, rows):
    filled = [(i, v, 1, "n", 2, None, 3) for i, v in rows]
    return spark.createDataFrame(filled, COLUMNS).repartition(3)


def reference(kept):
    """Everything by plain numpy, from (id, vector) rows."""
    x = np.floor(1024 * np.array([v for _, v in kept], np.float32).astype(float)).astype(int) + 100_000
    n, sums = len(x), x.sum(axis=0)
    y = x - sums / n
    covariance = y.T @ y / n
    values, vectors_ = np.linalg.eigh(covariance)
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    return y, values[::-1], vectors_[:, ::-1].T, np.trace(covariance), exact


def compare(rows, kept, components):
    y, values, axes, trace, exact = reference(kept)
    found = {}
    for r in rows:
        found.setdefault(r.component, []).append(r)
    assert sorted(found) == list(range(1, components + 1))
    for k in range(components):
        want = y @ axes[k] / np.sqrt(values[k])
        by_id = sorted(found[k + 1], key=lambda r: (r.vec_id is None, r.vec_id, r.whitened))
        got = np.array([r.whitened for r in by_id])
        order = sorted(range(len(kept)), key=lambda j: (kept[j][0] is None, kept[j][0] or 0))
        want = want[order]
        if np.abs(got - want).max() > np.abs(got + want).max():
            want = -want
        np.testing.assert_allclose(got, want, rtol=0, atol=1e-9)
        assert [int(r.deviation) for r in by_id] == [exact[j] for j in order]
        assert {r.n for r in by_id} == {len(kept)}
        assert by_id[0].explained == pytest.approx(values[k] / trace, rel=1e-9)
        assert by_id[0].identity_error < 1e-9


def test_query_against_brute_force(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = QUERIES["op13_embedding_whitening"](spark, SF).collect()
    kept = [(r.vec_id, r.embedding) for r in table.collect() if r.embedding is not None]
    assert len(rows) == 8 * len(kept)
    compare(rows, kept, 8)
    types = dict(QUERIES["op13_embedding_whitening"](spark, SF).dtypes)
    assert types["deviation"] == types["n"] == types["vec_id"] == "bigint"
    assert types["component"] == "int"


def test_odd_rows_take_no_part(spark):
    rng = np.random.default_rng(5)
    kept = [(i, [float(c) for c in rng.normal(size=5) * (1, 2, 3, 4, 5)]) for i in range(60)]
    kept.append((None, [0.0, 0.0, -0.0, 1.0, 0.5]))
    kept += [kept[7]] * 3
    odd = [
        (100, None),
        (101, []),
        (102, [1.0, None, 1.0, 1.0, 1.0]),
        (103, [1.0, float("nan"), 1.0, 1.0, 1.0]),
        (104, [1.0, float("inf"), 1.0, 1.0, 1.0]),
        (105, [1.0, 2.0**31, 1.0, 1.0, 1.0]),
        (106, [1.0, 2.0]),
    ]
    rows = whitening.whiten(vectors(spark, kept + odd)).collect()
    assert {r.vec_id for r in rows} == {i for i, _ in kept}
    assert len(rows) == 5 * len(kept)
    y, values, axes, _, _ = reference(kept)
    for k in range(5):
        got = sorted(abs(r.whitened) for r in rows if r.component == k + 1)
        want = np.sort(np.abs(y @ axes[k] / np.sqrt(values[k])))
        np.testing.assert_allclose(got, want, rtol=0, atol=1e-9)


@pytest.mark.parametrize(
    "rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)]]
)
def test_nothing_to_whiten(spark, rows):
    out = whitening.whiten(vectors(spark, rows))
    assert out.count() == 0
    assert out.columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    ]


def test_repeated_dimensions_have_one_component(spark):
    rows = [(i, [float(i), float(i), 7.0]) for i in range(20)]
    out = whitening.whiten(vectors(spark, rows)).collect()
    assert {r.component for r in out} == {1} and out[0].explained == pytest.approx(1)


def test_deviations_beyond_a_long_are_exact(spark):
    kept = [(i, [float(i % 7) * 2.0**27, float(i)]) for i in range(40)]
    rows = [r for r in whitening.whiten(vectors(spark, kept)).collect() if r.component == 1]
    exact = reference(kept)[4]
    assert [int(r.deviation) for r in sorted(rows, key=lambda r: r.vec_id)] == exact
    assert max(exact) > 2**63


def test_the_fit_does_not_depend_on_partitions(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    one, many = (
        whitening.fit(whitening.integers(table.repartition(n))) for n in (1, 7)
    )
    assert (one.vectors == many.vectors).all() and (one.values == many.values).all()


def test_inertia_counts():
    rng = np.random.default_rng(2)
    for trial in range(100):
        d = int(rng.integers(1, 25))
        a = rng.standard_normal((d, d))
        a = np.round(a + a.T) if trial % 2 else a + a.T
        shift = float(rng.standard_normal())
        assert above(a, shift) == (np.linalg.eigvalsh(a) > shift).sum()


@pytest.mark.parametrize(
    "values",
    [
        [5.0] * 6 + [1.0] * 10,
        [5, 5 + 1e-13, 5 + 2e-12, 4] + [1.0] * 12,
        list(np.linspace(1, 1.001, 16)),
        [3.0] + [0.0] * 15,
        [10.0**-k for k in range(16)],
        [0.0] * 16,
    ],
)
def test_leading_pairs(values):
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.standard_normal((16, 16)))[0]
    a = (q * np.array(values)) @ q.T
    try:
        found = leading(a, 8)
    except NotCertified as failure:
        pytest.fail(str(failure))
    want = [v for v in sorted(values, reverse=True)[:8] if v > 0]
    np.testing.assert_allclose(found.values, want, rtol=0, atol=1e-12 * max(values + [1]))
    k = len(found.values)
    np.testing.assert_allclose(found.vectors @ found.vectors.T, np.eye(k), atol=1e-9)
    error = a @ found.vectors.T - (found.vectors * found.values[:, None]).T
    assert np.abs(error).max(initial=0) < 1e-11 * max(values + [1])
