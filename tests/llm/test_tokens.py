import hashlib
import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from ratebook.llm import bpe, token_counts, tokens
from ratebook.llm.common import keyed
from ratebook.llm.tokens import ByteBpe, WordBpe, encoder, library


def encoded(kind, path, texts):
    ids, counts = encoder(kind, path).encode(pa.array(texts, pa.string()))
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]


def expected(path, texts):
    return [e.ids for e in library(path).encode_batch(texts, add_special_tokens=False)]


def test_cached_encoders_agree_with_the_library(words, pieces, corpus, odd):
    texts = [t or "" for _, t in odd + corpus]
    for kind, path in ((WordBpe, words), (ByteBpe, pieces)):
        for _ in range(2):  # learnt, then known
            assert encoded(kind, path, texts) == expected(path, texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=5))
def test_any_text(texts):
    import public_tokenizers as P

    for kind, name in ((WordBpe, "word_bpe_49k.json"), (ByteBpe, "byte_bpe_50k.json")):
        assert encoded(kind, P.path(name), texts) == expected(P.path(name), texts)


def test_wrong_pairs_are_encoded_again(words):
    """Words in which a checked pair does not hold go to the slow way."""
    own = WordBpe(words)
    ids, _ = own.encode(pa.array(["hedgehog unhappiness"]))
    own._clear()
    own._wrong = {int(a) << 32 | int(b) for a, b in zip(ids, ids[1:])}
    again, _ = own.encode(pa.array(["hedgehog unhappiness"]))
    assert again.tolist() == ids.tolist()


def test_trees_of_any_cut_agree_with_the_whole(words):
    own = encoder(WordBpe, words)
    rng = random.Random(2)

    def names(symbols):
        return bpe.sweep_bpe(own.ranks, symbols)

    for alphabet in ("a", "ab", "etaoin", "abcdefghijklmnopqrstuvwxyz", "0!?"):
        for _ in range(12):
            word = "".join(rng.choice(alphabet) for _ in range(rng.randint(2, 300)))
            whole = [t.value for t in own.library.model.tokenize(word)]
            step = rng.randint(1, 40)
            leaves = [
                [t.value for t in own.library.model.tokenize(word[k : k + step])]
                for k in range(0, len(word), step)
            ]
            assert bpe.tree(leaves, names) == whole
            assert names(bpe.symbols_of(word + tokens._SUFFIX)) == whole


def test_trees_of_texts_cut_anywhere_agree_with_the_whole(words, corpus):
    """Leaves end inside words and between them; no listed pair joins across a word's end."""
    own = encoder(WordBpe, words)
    assert not any(left.endswith(tokens._SUFFIX) for left, _ in own.ranks)
    model, rng = own.library.model, random.Random(5)

    def names(symbols):
        return bpe.sweep_bpe(own.ranks, symbols)

    for _, text in corpus[:40]:
        shown = own.library.normalizer.normalize_str(text or "")
        whole = [w for w, _ in own.library.pre_tokenizer.pre_tokenize_str(shown)]
        cuts = list(bpe.cut_leaves(" ".join(whole), rng.randint(1, 60)))
        leaves = [[t.value for w in leaf.split(" ") if w for t in model.tokenize(w)] for leaf, _ in cuts]
        found = bpe.tree(leaves, names, [opened for _, opened in cuts])
        assert found == [t.value for w in whole for t in model.tokenize(w)]


def test_words_are_shown_as_the_library_shows_them(words, odd, corpus):
    own = encoder(WordBpe, words)
    rows = odd + corpus + [(1, "\x7f\x85a\xa0b\xadc\x1dd 'S don'T İı ÿ \u024f ''s9²")]
    for _, text in rows:
        shown = own.library.normalizer.normalize_str(text or "")
        split = [w for w, _ in own.library.pre_tokenizer.pre_tokenize_str(shown)]
        assert own.shown_words(text or "") == " ".join(split)


def test_leaves():
    assert list(bpe.cut_leaves("abcd ef ghij", 4)) == [("abcd", False), ("ef", False), ("ghij", False)]
    assert list(bpe.cut_leaves("ab cdefg h", 4)) == [("ab c", True), ("defg", False), ("h", False)]
    assert list(bpe.cut_leaves("abcdefghij", 4)) == [("abcd", True), ("efgh", True), ("ij", False)]
    assert list(bpe.cut_leaves("", 4)) == [("", False)]


def long_rows():
    rng = random.Random(3)
    return [
        (20, "a" * 5000),
        (21, "".join(rng.choice("etaoin") for _ in range(7000)) + " tail"),
        (22, "x" * 900 + "<|endoftext|>" + "!" * 2000),
        (23, " ".join(f"w{n}" for n in range(3000))),
        (24, "y\n\n  z " * 800),
        (25, " \n" * 900),
        (26, "<|endoftext|>" * 80),
        (27, "Straße İstanbul 🙂 naïve 0123 don't " * 200),
    ]


def ordered(rows):
    return sorted((-1 if i is None else i, *rest) for i, *rest in rows)


def test_encode_and_decode(documents, words, odd, corpus):
    rows = odd + long_rows() + corpus[:30]
    made = bpe.encode(documents(rows), words, long=512)
    lib = library(words)
    ids = [(i, lib.encode(t or "", add_special_tokens=False).ids) for i, t in rows]
    assert ordered((r.doc_id, list(r.ids)) for r in made.collect()) == ordered(ids)
    decoded = ordered((r.doc_id, r.text) for r in bpe.decode(made, words).collect())
    assert decoded == ordered((i, lib.decode(x, skip_special_tokens=False)) for i, x in ids)
    digests = {r.doc_id: r for r in bpe.digests(made, words).collect()}
    assert len(digests[20].ids_sha256) == 64 and digests[2].n_tokens == 0
    assert digests[1].decoded_sha256 == digests[2].decoded_sha256
    at_once = bpe.encoded_digests(documents(rows), words, long=512).collect()
    assert sorted(map(repr, at_once)) == sorted(map(repr, bpe.digests(made, words).collect()))
    want = [(i, len(x), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest()) for i, x in ids]
    found = [(r.doc_id, r.n_tokens, r.ids_sha256) for r in at_once]
    assert ordered(found) == ordered(want)


def test_long_texts_go_by_the_tree(documents, words, corpus):
    """Any cut of any long text gives the library's ids, also over several branches."""
    rows = long_rows() + corpus
    lib = library(words)
    ids = [(i, lib.encode(t or "", add_special_tokens=False).ids) for i, t in rows]
    made = bpe.encode(documents(rows), words, long=61, halved=300).collect()
    assert ordered((r.doc_id, list(r.ids)) for r in made) == ordered(ids)


def test_counts_with_overlaps(documents, pieces, odd, corpus):
    rows = odd + long_rows() + corpus[:30]
    found = token_counts.count_tokens(documents(rows), pieces, chunk=600, overlap=200)
    lib = library(pieces)
    want = [
        (i, len((t or "").encode()), len(lib.encode(t or "", add_special_tokens=False).ids))
        for i, t in rows
    ]
    assert ordered((r.doc_id, r.n_bytes, r.n_tokens) for r in found.collect()) == ordered(want)


def test_empty_tables(documents, words, pieces):
    empty = documents([])
    assert bpe.encode(empty, words).count() == 0
    assert token_counts.count_tokens(empty, pieces).count() == 0
    assert keyed(empty).count() == 0
