import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from ratebook.llm import suffix_dedup
from ratebook.llm.lyndon import suffix_array


@settings(max_examples=400, deadline=None)
@given(st.integers(1, 4).flatmap(lambda k: st.lists(st.integers(0, k), max_size=60)))
def test_suffix_array(text):
    assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_long_runs():
    for text in (b"a" * 3000, b"ab" * 1500, b"aab" * 900 + b"aaa"):
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def brute_force(rows, length):
    first = {}
    for i, text in rows:
        raw, key = (text or "").encode(), (1 << 63) - 1 if i is None else i
        for s in range(len(raw) - length + 1):
            window = raw[s : s + length]
            first[window] = min(first.get(window, (1 << 64, 0)), (key, s))
    out = []
    for i, text in rows:
        raw, key = (text or "").encode(), (1 << 63) - 1 if i is None else i
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            if first[raw[s : s + length]] < (key, s):
                gone[s : s + length] = b"\1" * length
        left = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append(
            (-1 if i is None else i, len(raw), sum(gone), runs, hashlib.sha256(left).hexdigest())
        )
    return sorted(out)


def found(docs, **options):
    rows = suffix_dedup.digests(docs, **options).collect()
    return sorted(
        (-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
        for r in rows
    )


def passages(rng, count, size):
    """Texts that share parts of a passage between their own words."""
    shared = "".join(rng.choice("abcd ") for _ in range(size))
    for k in range(count):
        own = ["".join(rng.choice("xyz") for _ in range(rng.randint(0, 2 * size))) for _ in "12"]
        a, b = rng.randint(0, size // 4), rng.randint(3 * size // 4, size)
        yield 1000 + k, own[0] + shared[a:b] + own[1]


def test_against_brute_force(documents, odd, corpus):
    rng = random.Random(4)
    rows = odd + corpus[:80] + list(passages(rng, 30, 140))
    rows += [(40, "a" * 250 + "b" + "a" * 250), (41, "é" * 200), (42, "x" * 51 + "é" * 200)]
    assert found(documents(rows)) == brute_force(rows, 100)


def test_short_strings_and_small_runs(documents, monkeypatch):
    """Many parting places: few bytes a suffix array, few anchors a batch."""
    monkeypatch.setattr(suffix_dedup, "SORTED_BYTES", 300)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 97)
    rng = random.Random(5)
    rows = list(passages(rng, 25, 40))
    rows += [(k, "".join(rng.choice("ab") for _ in range(300))) for k in range(5)]
    assert found(documents(rows), length=16, kgram=6) == brute_force(rows, 16)


def test_crowded_anchors_are_dealt_to_groups(documents, odd, monkeypatch):
    """No group of blocks is much larger than `MANY`, whatever an anchor has."""
    monkeypatch.setattr(suffix_dedup, "MANY", 8)
    rng = random.Random(8)
    rows = odd + list(passages(rng, 120, 140))
    rows += [(None, rows[20][1])] * 3 + [(1001, t) for _, t in rows[30:33]] + rows[40:42]
    docs = documents(rows)
    assert found(docs) == brute_force(rows, 100)
    keyed = suffix_dedup.keyed(docs)
    judged = suffix_dedup._judged(keyed, 100, suffix_dedup.KGRAM)
    assert judged.where("not gone").groupBy("key").count().agg({"count": "max"}).first()[0] > 50
    edges, within = suffix_dedup._parting(keyed, judged, 100)
    groups = edges.groupBy("key").count().collect()
    assert within[0].count()
    assert len(groups) > 8 and max(r["count"] for r in groups) <= 3 * 8


def test_texts_without_repeats(documents):
    rows = [(1, "é" * 60 + "A"), (2, "_" + "é" * 60 + "B"), (3, None), (4, ""), (None, "z")]
    docs = documents(rows)
    left = suffix_dedup.without_repeats(docs)
    assert left.columns == docs.columns
    texts = {r.doc_id: r.text for r in left.collect()}
    # the first text repeats itself from its second character on
    assert texts == {1: "éA", 2: "_B", 3: None, 4: "", None: "z"}
    assert suffix_dedup.digests(documents([])).count() == 0
