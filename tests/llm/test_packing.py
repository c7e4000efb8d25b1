import random
import zlib
from collections import defaultdict

import numpy as np

from ratebook.llm import packing
from ratebook.llm.tokens import library


def test_segment_tree_finds_the_tightest_room():
    rng = random.Random(1)
    rooms, kept = packing.Rooms(100), []
    for n in range(600):
        need = rng.randint(1, 100)
        fits = [r for r, _ in kept if r >= need]
        found = rooms.tightest(need)
        assert found == (min(fits) if fits else None)
        if found and rng.random() < 0.5:
            taken = rooms.take(found)
            kept.remove((found, taken))
        else:
            room = rng.randint(0, 100)
            rooms.put(room, n)
            kept.append((room, n))


def test_best_fit_decreasing():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 51, 400)
    window, offset = packing.best_fit_decreasing(lengths, 50)
    left: list[int] = []
    for need in sorted(lengths.tolist(), reverse=True):
        fits = [r for r in left if r >= need]
        if fits:
            left[left.index(min(fits))] -= need
        else:
            left.append(50 - need)
    sums = np.bincount(window, lengths)
    assert sorted((50 - sums).tolist()) == sorted(left)
    for w in range(len(sums)):
        own = np.flatnonzero(window == w)
        own = own[np.argsort(offset[own])]
        assert offset[own].tolist() == (np.cumsum(lengths[own]) - lengths[own]).tolist()


def test_pieces_hold_every_id_once(documents, words, odd, corpus):
    rows = [r for r in odd if r[0] != 5] + [(i + 100, t) for i, t in corpus[:60]]
    made = packing.pack(packing.pieces(documents(rows), words, window=64), 64, group=100)
    found = made.collect()
    lib = library(words)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
        assert r.length == len(r.ids) <= 64
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    for i, text in rows:
        own = sorted(by_doc[i], key=lambda r: r.start)
        ids = [x for r in own for x in r.ids]
        assert ids == [*lib.encode(text or "", add_special_tokens=False).ids, packing.END]
        assert [r.start for r in own] == [sum(q.length for q in own[:k]) for k in range(len(own))]
        assert {r.doc_tokens for r in own} == {len(ids)}
    for own in by_sequence.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(q.length for q in own[:k]) for k in range(len(own))]
        assert sum(r.length for r in own) <= 64
    assert sum(r.length for r in found) / (64 * len(by_sequence)) > 0.95


def test_repeated_rows_and_empty_tables(documents, words):
    twice = packing.pack(packing.pieces(documents([(1, "one two")] * 2), words, keep_ids=False))
    assert twice.count() == 2 and "ids" not in twice.columns
    assert packing.pack(packing.pieces(documents([]), words)).count() == 0
