import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from ratebook.llm import chosen_path
from ratebook.llm.components import components


def shingles(text):
    words = (text or "").lower().split()
    return frozenset(
        tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)) if words
    )


def brute_force(rows):
    sets = [shingles(t) for _, t in rows]
    holders = defaultdict(list)
    for n, s in enumerate(sets):
        for x in s:
            holders[x].append(n)
    links, above = [0] * len(rows), list(range(len(rows)))

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for a, s in enumerate(sets):
        shared = Counter(b for x in s for b in holders[x] if b > a)
        for b, n in shared.items():
            if 5 * n >= 4 * (len(s) + len(sets[b]) - n):
                links[a] += 1
                links[b] += 1
                above[max(top(a), top(b))] = min(top(a), top(b))
    least = {}
    for n, (i, _) in enumerate(rows):
        key = (1 << 63) - 1 if i is None else i
        least[top(n)] = min(least.get(top(n), key), key)
    return sorted(
        (-1 if i is None else i, -1 if least[top(n)] == (1 << 63) - 1 else least[top(n)], links[n])
        for n, (i, _) in enumerate(rows)
    )


def found(docs, **options):
    return sorted(
        (
            -1 if r.doc_id is None else r.doc_id,
            -1 if r.class_id is None else r.class_id,
            r.n_links,
        )
        for r in chosen_path.near_duplicates(docs, **options).collect()
    )


def near_copies(count, size=120):
    rng = random.Random(6)
    words = [f"w{n}" for n in range(60)]
    base = [rng.choice(words) for _ in range(size)]
    for k in range(count):
        own = list(base)
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(size)] = rng.choice(words)
        yield 5000 + k, " ".join(own)


def test_against_brute_force(documents, odd, corpus):
    rows = odd + corpus + list(near_copies(40)) + [(8, "A  row without\nan id"), (9, "A ROW")]
    rows += [(rows[12][0], rows[12][1])] * 2
    assert found(documents(rows)) == brute_force(rows)


def test_large_nodes_are_split_and_dealt_to_blocks(documents):
    rows = list(near_copies(60))
    assert found(documents(rows), leaf=8, block=16, depth=2) == brute_force(rows)


def test_one_of_each(documents):
    rows = [(3, "a b c"), (2, "A b  C"), (2, "A b  C"), (None, "a b c"), (5, ""), (6, None), (7, "x")]
    docs = documents(rows)
    kept = chosen_path.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted(
        [(2, "A b  C"), (5, ""), (6, None), (7, "x")], key=lambda r: r[0]
    )
    assert chosen_path.near_duplicates(documents([])).count() == 0


def test_runs_reach_the_recall():
    assert chosen_path.survival(1) == 1 - np.exp(-1)
    runs = chosen_path.runs_for(0.999, 3)
    assert (1 - chosen_path.survival(3)) ** runs <= 0.001
    assert (1 - chosen_path.survival(3)) ** (runs - 1) > 0.001


def test_lower_similarity(documents):
    """Pairs that share 0.536 of their shingles, looked for at 0.5."""
    rng = random.Random(12)
    rows = []
    for k in range(40):
        words = [f"w{rng.randrange(10**6)}" for _ in range(120)]
        other = [f"o{n}" if n % 15 == 8 and n < 105 else w for n, w in enumerate(words)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    a, b = shingles(rows[0][1]), shingles(rows[1][1])
    assert 0.5 < len(a & b) / len(a | b) < 0.55
    assert found(documents(rows), similarity=0.5) == [(n, n - n % 2, 1) for n in range(80)]


def test_limits_follow_the_similarity():
    assert chosen_path.least_shared(0.8) == 38 and chosen_path.least_shared(0.5) == 16
    assert len(chosen_path.roots(0.999, 3, 0.8)) <= chosen_path.T
    with pytest.raises(ValueError):
        chosen_path.roots(0.999, 3, 0.1)


def test_exact_links():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 40, 30)).astype(np.uint64) for _ in range(25)]
    sets.append(np.zeros(0, np.uint64))
    want = np.array(
        [
            [
                a is not b
                and len(np.intersect1d(a, b)) > 0
                and 5 * len(np.intersect1d(a, b)) >= 3 * len(np.union1d(a, b))
                for b in sets
            ]
            for a in sets
        ]
    )
    assert (chosen_path.linked(sets, 0.6) == want).all()


def test_components(spark):
    links = [(k, k + 1) for k in range(20)] + [(100, 7)] + [(50, 60), (60, 50), (61, 60), (9, 9)]
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    labels = {r.node: r.component for r in rows}
    assert len(rows) == len(labels)
    assert {labels[k] for k in [*range(21), 100]} == {0}
    assert {labels[k] for k in (50, 60, 61)} == {50}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
