"""BPE encoding and decoding by tree concatenation.

Ordinary texts are encoded chunk by chunk (see `tokens`).  A long text, of more than `HALVED`
characters or with a word of more than `LONG` symbols, is one row of symbols, in which the
last symbol of a word carries its end.  The row is cut into leaves of `LONG` symbols, wherever
that falls, and Spark encodes the leaves in parallel.  Neighbouring encodings are then joined
in a tree, `BRANCH` leaves in a task and then the branches of a text: the symbols of the last
tokens on the left and the first ones on the right are encoded again, in a window that doubles
until its first token is the one that the left side has there and its last token the one of
the right side.  A cut that falls between two words needs no window: nothing joins across the
end of a word.

Why that is exact: a row of tokens is the encoding of its text exactly if every two
neighbours are the encoding of theirs.  Pairs inside the left side, inside the window and
inside the right side hold, and the tokens at which the window meets them are the same.  When
the window reaches the end of a side, it is that side's encoding.

Defined cases: a null text is empty; an empty text has no ids and decodes to an empty text;
a null id is kept; repeated rows are encoded each.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratebook.llm.common import batch_of, prepare, slices, stored, texts
from ratebook.llm.tokens import _SUFFIX, WordBpe, encoder

#: Symbols of a leaf; a text with a longer word is encoded as a tree of leaves.
LONG = 1 << 12
#: So is one of more characters.
HALVED = 1 << 14
#: Neighbouring leaves that one task joins.
BRANCH = 16
#: Encodings of words that a worker keeps.
KEPT_WORDS = 100_000
#: Tokens on each side of a join that are encoded again at first.
WINDOW = 4

Encode = Callable[[list[str]], list[str]]


def sweep_bpe(ranks: dict[tuple[str, str], int], symbols: list[str]) -> list[str]:
    """Join the listed pair of lowest rank, leftmost first, until none is left.

    Joining makes only pairs of higher rank, so one sweep joins all pairs of a rank.
    """
    while len(symbols) > 1:
        best = min(zip(symbols, symbols[1:]), key=lambda p: ranks.get(p, len(ranks)))
        if best not in ranks:
            break
        joined, k = [], 0
        while k < len(symbols):
            if k + 1 < len(symbols) and (symbols[k], symbols[k + 1]) == best:
                joined.append(symbols[k] + symbols[k + 1])
                k += 2
            else:
                joined.append(symbols[k])
                k += 1
        symbols = joined
    return symbols


def symbols_of(token: str) -> list[str]:
    """Single symbols of a token; a word's last one keeps the word end."""
    word = token.removesuffix(_SUFFIX)
    symbols = list(word)
    if word != token:
        symbols[-1] += _SUFFIX
    return symbols


def concatenate(left: list[str], right: list[str], encode: Encode, window: int = WINDOW):
    """The encoding of the text of both sides, from the encodings of each.

    The left side was encoded as if its word ended there, so its last token is always
    encoded again, without the word end.  Without `encode` the cut is between two words.
    """
    if not (left and right and encode):
        return left + right
    a, found, b = meeting(left, right, list, encode, window)
    return left[: len(left) - a] + found + right[b:]


def meeting(left, right, named, encode: Encode, window: int = WINDOW) -> tuple[int, list[str], int]:
    """How many tokens at the end of the left side and at the beginning of the right one give
    way, and to which; `named` gives the strings of a stretch of either."""
    a = b = window
    while True:
        a, b = min(a, len(left)), min(b, len(right))
        head, tail = named(left[len(left) - a :]), named(right[:b])
        head = [*head[:-1], head[-1].removesuffix(_SUFFIX)]
        found = encode([s for token in head + tail for s in symbols_of(token)])
        # The window's first token must be the left side's and end on its side of the join.
        left_agrees = a == len(left) or (a > 1 and found[0] == head[0])
        right_agrees = b == len(right) or (b > 1 and found[-1] == tail[-1])
        if left_agrees and right_agrees and (len(found) > 1 or a + b == len(left) + len(right)):
            return a, found, b
        a, b = (a if left_agrees else 2 * a), (b if right_agrees else 2 * b)
        if left_agrees and right_agrees:
            a, b = 2 * a, 2 * b


def tree(
    leaves: list, encode: Encode, opened: list[bool] | None = None, join: Callable = concatenate
):
    """Neighbours joined level by level; `opened` says which leaves end inside a word."""
    opened = opened or [True] * len(leaves)
    while len(leaves) > 1:
        leaves = [
            side if k + 1 == len(leaves) else join(side, leaves[k + 1], encode if opened[k] else None)
            for k, side in enumerate(leaves)
            if k % 2 == 0
        ]
        opened = [*opened[1::2], *opened[len(opened) - len(opened) % 2 :]]
    return leaves[0] if leaves else []


def _digest(ids: np.ndarray, names: list[str]) -> tuple[int, str, str]:
    return (
        len(ids),
        hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
        hashlib.sha256(" ".join(names).encode()).hexdigest(),
    )


_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])


def _encode_plain(path: str, digest: bool):
    """Ids of whole texts, or their digests: those are made where the ids are, which takes
    one Python worker less and keeps the ids out of the exchange between two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(WordBpe, path)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, counts = words.encode(part.column("text"))
                ends = np.concatenate(([0], np.cumsum(counts)))
                doc_id = part.column("doc_id")
                if digest:
                    yield _digested(path, doc_id, [ids[a:b] for a, b in zip(ends, ends[1:])])
                    continue
                lists = pa.LargeListArray.from_arrays(
                    pa.array(ends, pa.int64()), pa.array(ids.astype(np.int32))
                ).cast(pa.list_(pa.int32()))
                yield batch_of(_ENCODED, doc_id=doc_id, ids=lists)

    return run


_LEAVES = pa.schema(
    [("row", pa.int64()), ("part", pa.int64()), ("leaf", pa.int64()), ("opened", pa.bool_()),
     ("symbols", pa.string()), ("ids", pa.list_(pa.int32()))]
)
_LEAF_COLUMNS = (
    "row long, part long, leaf long, opened boolean, symbols string, ids array<int>"
)


def cut_leaves(symbols: str, long: int) -> Iterator[tuple[str, bool]]:
    """Every `long` symbols, the blanks between words counted, and whether a word goes on."""
    for start in range(0, max(1, len(symbols)), long):
        end = start + long
        opened = end < len(symbols) and " " not in symbols[end - 1 : end + 1]
        yield symbols[start:end].strip(" "), opened


def _take_apart(path: str, long: int):
    """Leaves of long texts; a special string is a part of its own between two others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(WordBpe, path)
        tokenizer = words.library
        specials = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}

        def leaves_of(text: str) -> Iterator[tuple[bool, str | None, list[int] | None]]:
            if text in specials:
                yield False, None, [specials[text]]
                return
            for symbols, opened in cut_leaves(words.shown_words(text), long):
                yield opened, symbols, None

        for batch in batches:
            for row in batch.to_pylist():
                rows = [
                    (row["row"], part, leaf, *values)
                    for part, text in enumerate(_between(row["text"], list(specials)))
                    for leaf, values in enumerate(leaves_of(text))
                ]
                yield batch_of(_LEAVES, **dict(zip(_LEAVES.names, map(list, zip(*rows)))))

    return run


def _between(text: str, marks: list[str]) -> list[str]:
    """The text cut around special strings, which stay."""
    parts = [text]
    for mark in marks:
        cut = []
        for part in parts:
            if part in marks:
                cut.append(part)
                continue
            pieces = part.split(mark)
            cut += [x for p in pieces for x in (p, mark)][:-1]
        parts = cut
    return [p for p in parts if p]


class _Known(dict):
    """Word -> its ids, kept."""

    def __init__(self, model) -> None:
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> list[int]:
        if len(self) > KEPT_WORDS:
            self.clear()
        found = self[word] = [t.id for t in self.model.tokenize(word)]
        return found


def _encode_leaves(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(encoder(WordBpe, path).library.model)
        for batch in batches:
            found = []
            for symbols, given in zip(batch.column("symbols").to_pylist(), batch.column("ids")):
                words = symbols.split(" ") if symbols else []
                found.append(
                    _array(given)
                    if symbols is None
                    else np.fromiter(chain.from_iterable(map(known.__getitem__, words)), np.int32)
                )
            same = {n: batch.column(n) for n in ("row", "part", "leaf", "opened")}
            yield batch_of(_LEAVES, **same, symbols=pa.nulls(len(found), pa.string()), ids=found)

    return run


def _joined(path: str, leaves: list[np.ndarray], opened: list[bool]) -> np.ndarray:
    """The ids of neighbouring leaves as one row; only those in a window become strings."""
    words, names = encoder(WordBpe, path), _names(path)

    def encode(symbols: list[str]) -> list[str]:
        return sweep_bpe(words.ranks, symbols)

    def join(left: np.ndarray, right: np.ndarray, encode: Encode | None) -> np.ndarray:
        if not (len(left) and len(right) and encode):
            return np.concatenate((left, right))
        a, found, b = meeting(left, right, lambda ids: names[ids].tolist(), encode)
        between = np.array([words.vocabulary[t] for t in found], np.int32)
        return np.concatenate((left[: len(left) - a], between, right[b:]))

    return tree(leaves, encode, opened, join)


def _leaves_of(table: pa.Table) -> tuple[list[np.ndarray], list[bool]]:
    return list(map(_array, table.column("ids"))), table.column("opened").to_pylist()


_BRANCHES = pa.schema(
    [("row", pa.int64()), ("part", pa.int64()), ("leaf", pa.int64()), ("opened", pa.bool_()),
     ("ids", pa.list_(pa.int32()))]
)


def _join_branch(path: str):
    """Some neighbouring leaves of a part as one."""

    def run(key, table):
        leaves, opened = _leaves_of(table.sort_by("leaf"))
        ids = _joined(path, leaves, opened)
        row, part, leaf = (k.as_py() for k in key)
        return pa.table(
            [[row], [part], [leaf], [opened[-1]], pa.array([ids], pa.list_(pa.int32()))],
            schema=_BRANCHES,
        )

    return run


def _join_branches(path: str, digest: bool):
    """All of a text: its ids, or their digest."""

    def run(key, table):
        table = table.sort_by([("part", "ascending"), ("leaf", "ascending")])
        # no leaf at the end of a part is open, so parts are joined as words are
        ids = _joined(path, *_leaves_of(table))
        row = pa.array([key[0].as_py()], pa.int64())
        if digest:
            found = pa.Table.from_batches([_digested(path, row, [ids])])
            return found.rename_columns(["row", *found.column_names[1:]])
        return pa.table({"row": row, "ids": pa.array([ids], pa.list_(pa.int32()))})

    return run


def _encoded(
    docs: DataFrame,
    path: str,
    digest: bool,
    id_col: str = "doc_id",
    text_col: str = "text",
    long: int = LONG,
    halved: int = HALVED,
) -> DataFrame:
    prepare(docs.sparkSession)
    plain = texts(docs, id_col, text_col)
    # A symbol is a byte; a run of fewer characters than this holds no long word.
    apart = (F.length("text") > halved) | F.col("text").rlike(
        f"(?<![^ \\n\\t\\r])[^ \\n\\t\\r]{{{max(1, long // 8)},}}"
    )
    ready = plain.where(~apart).mapInArrow(
        _encode_plain(path, digest), _DIGEST_COLUMNS if digest else "doc_id long, ids array<int>"
    )
    rows = stored(
        plain.where(apart).withColumn("row", F.monotonically_increasing_id()), "long-texts"
    )
    joined = (
        rows.select("row", "text")
        .mapInArrow(_take_apart(path, long), _LEAF_COLUMNS)
        .repartition("row", "part", "leaf")
        .mapInArrow(_encode_leaves(path), _LEAF_COLUMNS)
        .drop("symbols")
        .groupBy("row", "part", F.expr(f"leaf div {BRANCH}").alias("branch"))
        .applyInArrow(
            _join_branch(path), "row long, part long, leaf long, opened boolean, ids array<int>"
        )
        .groupBy("row")
        .applyInArrow(
            _join_branches(path, digest),
            _DIGEST_COLUMNS.replace("doc_id", "row") if digest else "row long, ids array<int>",
        )
    )
    # a text of special strings and blanks alone has a row too; an empty one is not taken apart
    joined = rows.select("row", "doc_id").join(joined, "row").drop("row")
    return ready.unionByName(joined)


def encode(docs: DataFrame, path: str, **options) -> DataFrame:
    """(doc_id, ids), a row for each row of `docs`."""
    return _encoded(docs, path, digest=False, **options)


def encoded_digests(docs: DataFrame, path: str, **options) -> DataFrame:
    """`digests` of `encode`."""
    return _encoded(docs, path, digest=True, **options)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text): the tokens' own strings with a space between, as the library decodes."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.large_string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = _names(path)
        for batch in batches:
            texts_ = [
                " ".join(names[i].tolist()) if len(i) else ""
                for i in map(_array, batch.column("ids"))
            ]
            yield batch_of(schema, doc_id=batch.column("doc_id"), text=texts_)

    return encoded.mapInArrow(run, "doc_id long, text string")


def _array(scalar) -> np.ndarray:
    return np.asarray(scalar.values) if scalar.is_valid else np.zeros(0, np.int32)


def _names(path: str) -> np.ndarray:
    words = encoder(WordBpe, path)
    if not hasattr(words, "by_id"):
        words.by_id = np.array(
            [words.names.get(i, "") for i in range(max(words.names) + 1)], object
        )
    return words.by_id


_DIGESTED = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
     ("decoded_sha256", pa.string())]
)
_DIGEST_COLUMNS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _digested(path: str, doc_id: pa.Array, ids: list[np.ndarray]) -> pa.RecordBatch:
    names = _names(path)
    found = [_digest(i, names[i].tolist()) for i in ids]
    columns = list(zip(*found)) if found else [[]] * 3
    return batch_of(
        _DIGESTED, doc_id=doc_id, **dict(zip(_DIGESTED.names[1:], map(list, columns)))
    )


def digests(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoded texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _digested(path, batch.column("doc_id"), list(map(_array, batch.column("ids"))))

    return encoded.mapInArrow(run, _DIGEST_COLUMNS)
