import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import sentencepiece

from ratebook.llm import fertility
from ratebook.llm.queries import QUERIES, piece_vocabulary

SF = "/root/testdata/sf0.01"
COLUMNS = (
    "doc_id long, text string, lang string, language string, length int, entropy string, "
    "kept int, reason string, n_words string"
)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def table(spark, rows):
    return spark.createDataFrame(
        [(*r, "l", 1, "e", 0, "r", "w") for r in rows], COLUMNS
    ).repartition(3)


def base(doc_id, text):
    """The plain counts, straight from their definition."""
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            inside |= set(range(i, i + 8))
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
    return (
        doc_id, len(words), sum(map(len, words)), symbols, repeated, len(inside), failed
    )


def figures(text, pieces):
    """Figures of a text, token by token."""
    words = WORD.findall(text or "")
    tokens = [t for w in words for t in pieces.encode(w)]
    if not tokens:
        return None, None, None
    n = len(tokens)
    blocks = max(n // fertility.BLOCK, 1)
    cut = [[] for _ in range(blocks)]
    for i, t in enumerate(tokens):
        cut[i * blocks // n].append(t)
    shares = []
    for block in cut:
        counts = Counter(block).values()
        bits = -sum(c / len(block) * math.log2(c / len(block)) for c in counts)
        shares.append(bits / math.log2(len(block)) if len(block) > 1 else 1)
    return (
        sum(shares) / blocks,
        sum(map(len, words)) / n,
        sum(pieces.is_byte(t) for t in tokens) / n,
    )


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=piece_vocabulary())


def verdicts(found):
    """Bands and reasons from the figures, by sorting instead of counting cells."""
    groups = {}
    for key, n, values in found.values():
        if n:
            size = int(math.log2(n))
            for by in ((key, size), (key,), ()):
                groups.setdefault(by, []).append(values)

    def quartile(values, q):
        cells = sorted(math.floor(v / fertility.CELL + 0.5) for v in values)
        return cells[math.ceil(q * len(cells)) - 1] * fertility.CELL

    out = {}
    for doc_id, (key, n, values) in found.items():
        out[doc_id] = None
        if not n:
            continue
        size = int(math.log2(n))
        level = next(
            by for by in ((key, size), (key,), ()) if not by or len(groups[by]) >= fertility.ENOUGH
        )
        for k, (name, (below, over)) in enumerate(fertility.BANDS.items()):
            own = [v[k] for v in groups[level]]
            low, middle, high = (quartile(own, q) for q in (0.25, 0.5, 0.75))
            spread = max((high - low) / 2 / 0.6745, fertility.LEAST[name])
            if below is not None and values[k] < middle - below * spread:
                out[doc_id] = out[doc_id] or name
            if over is not None and values[k] > middle + over * spread:
                out[doc_id] = out[doc_id] or name
    return out


def test_query_against_brute_force(spark, pieces):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    frame = QUERIES["op12_fertility_rules"](spark, SF)
    types = dict(frame.dtypes)
    assert {types[c] for c in BASE[:-1]} == {"bigint"}
    assert types["base_failed"] == types["kept"] == "boolean"
    rows = frame.collect()
    want = {r.doc_id: base(r.doc_id, r.text) for r in docs}
    assert {r.doc_id: tuple(r[c] for c in BASE) for r in rows} == want
    found = {r.doc_id: (r.lang, 0, ()) for r in docs}
    for r in docs:
        tokens = sum(len(pieces.encode(w)) for w in WORD.findall(r.text or ""))
        found[r.doc_id] = (r.lang, tokens, figures(r.text, pieces))
    reasons = verdicts(found)
    for r in rows:
        np.testing.assert_allclose(
            [r.entropy, r.chars_per_token, r.byte_share], found[r.doc_id][2], rtol=1e-9, atol=1e-12
        )
        assert r.n_tokens == found[r.doc_id][1]
        expected = not r.base_failed and reasons[r.doc_id] is None
        assert r.kept == expected, (r, reasons[r.doc_id])


def test_junk_goes_and_clean_texts_stay(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op12_fertility_rules"](spark, SF).collect() if r.doc_id in labels]
    junk = [r for r in rows if not labels[r.doc_id]]
    clean = [r for r in rows if labels[r.doc_id] and not r.base_failed]
    assert sum(not r.kept for r in junk) > 0.9 * len(junk)
    assert sum(r.kept for r in clean) > 0.98 * len(clean)


def test_odd_rows(spark):
    rng = random.Random(1)
    plain = ["the", "house", "water", "green", "small", "river", "stone", "light", "of", "and"]
    rows = [(i, " ".join(rng.choices(plain, k=60)), "en") for i in range(40)]
    same = " ".join(f"w{i}" for i in range(30))
    odd = [
        (100, None, "en"),
        (101, "", None),
        (102, " \t\n\v\f\r ", ""),
        (None, same, "en"),
        (103, same, "en"),
        (103, same, "en"),
        (104, "東京 " * 30, None),
        (105, "привет мир " * 20, ""),
        (106, "#*$%&|<> " * 25, "en"),
        (107, "a b\n\n a b\na b\na b c\na b c\n", "en"),
        (108, "x" * 300_000 + " " + same, "en"),
        (109, "one two three four five six seven eight " * 2, "en"),
    ]
    found = fertility.judged(table(spark, rows + odd), piece_vocabulary()).collect()
    got = Counter(tuple(r[c] for c in BASE) for r in found)
    assert got == Counter(base(i, t) for i, t, _ in rows + odd)
    by_id = {r.doc_id: r for r in found}
    assert by_id[100].entropy is None and by_id[100].reason == "words" and not by_id[100].kept
    assert by_id[101].language == by_id[102].language == "script:NONE"
    assert by_id[104].language == "script:CJK" and by_id[105].language == "script:CYRILLIC"
    assert by_id[109].n_repeat_words == 16 and by_id[109].reason == "words"
    assert by_id[None].kept == by_id[103].kept


def test_empty_table(spark):
    assert fertility.judged(table(spark, []), piece_vocabulary()).count() == 0


def test_word_numbers_survive_a_full_table(monkeypatch):
    monkeypatch.setattr(fertility, "KEPT_WORDS", 3)
    vocabulary = fertility.Vocabulary(piece_vocabulary())
    texts = ["one two three four", "four five", "one"]
    languages = ["en"] * 3
    whole = fertility.measured(texts, languages, vocabulary)
    for k, text in enumerate(texts):
        own = fertility.measured([text], ["en"], vocabulary)
        assert all(own[c][0] == whole[c][k] for c in whole)


@pytest.mark.parametrize("seed", range(5))
def test_repeated_windows(seed):
    rng = np.random.default_rng(seed)
    texts = [rng.integers(0, 2 + seed, rng.integers(0, 60)) for _ in range(30)]
    got = fertility.repeated_words(
        np.concatenate(texts).astype(np.int64), np.cumsum([len(t) for t in texts])
    )
    want = [base(0, " ".join(f"w{n}" for n in t))[5] for t in texts]
    assert got.tolist() == want
