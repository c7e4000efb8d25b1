"""Quality rules by tokeniser fertility.

A vocabulary made for ordinary text cuts ordinary text into few, varied tokens.  Of each text
three figures are taken from a public vocabulary with byte fallback:

* `chars_per_token`: code points outside white space, by token;
* `byte_share`: the share of tokens that stand for a single byte, as no other fits;
* `entropy`: of the tokens of a block, as a share of the most that a block of its length can
  have; the mean over blocks of about `BLOCK` tokens that lie one after the other, so that a
  long text is not taken for a varied one.

What is ordinary differs by language, and figures of short texts scatter.  So each language, and
each script of the texts without one, has bands of its own for each doubling of a text's length
in tokens.  They come from counts over all texts: the median, and a spread from the quartiles,
which a share of junk hardly moves.  A text beyond `BANDS` spreads is rejected.  A length with fewer than
`ENOUGH` texts of its language takes the bands of all its lengths, or of all texts.

Beside them stand plain counts (words, their characters, symbols, repeated lines and words), and
two limits on them.

Words are what white space (space, \\t to \\r) separates, and are tokenised one by one: no piece
of the vocabulary spans white space, and a word met before isn't cut again.  Texts are read
whole.  Defined cases: a null or empty text has no words and fails the limits; its figures are
null.  A null id is kept; of repeated rows each has its own result.  A null or empty language is
the script most letters belong to, `script:NONE` without letters.  Other columns are not read.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratebook.llm.common import batch_of, prepare, ragged, slices, stored

BLOCK = 64
#: Texts that a band needs.
ENOUGH = 30
#: Spreads that a figure may lie below and above its median.
BANDS = {"entropy": (3.5, None), "chars_per_token": (8.0, 8.0), "byte_share": (None, 10.0)}
#: A spread at least: most texts have no byte of their own, and one is no reason to go.
LEAST = {"entropy": 0.002, "chars_per_token": 0.01, "byte_share": 0.01}
#: Figures are counted in cells of this width.
CELL = 1 / 4096
#: Bands (about 100 bytes each) that are sent to every task; more of them are joined.
SENT_BANDS = 200_000
#: Words that are known by their tokens at once.
KEPT_WORDS = 200_000
#: Words of a repeated window, and the limits on the plain counts.
WINDOW = 8
FEWEST_WORDS = 20
MOST_REPEATED = 30  # per cent

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\v\f\r"

_FIGURES = tuple(BANDS)
_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("language", pa.string()),
        ("n_words", pa.int64()),
        ("word_chars", pa.int64()),
        ("n_symbols", pa.int64()),
        ("n_dup_lines", pa.int64()),
        ("n_repeat_words", pa.int64()),
        ("n_tokens", pa.int64()),
        *[(f, pa.float64()) for f in _FIGURES],
    ]
)
_DDL = (
    "doc_id long, language string, n_words long, word_chars long, n_symbols long, "
    "n_dup_lines long, n_repeat_words long, n_tokens long, "
    + ", ".join(f"{f} double" for f in _FIGURES)
)


# --- one batch of texts -----------------------------------------------------


def script_of(text: str) -> str:
    """The script of most letters, by their Unicode names."""
    found: Counter = Counter()
    for char, n in Counter(text).items():
        if char.isalpha():
            found[unicodedata.name(char, "OTHER").split()[0].split("-")[0]] += n
    best = max(found.items(), key=lambda item: (item[1], item[0]), default=("NONE", 0))
    return f"script:{best[0]}"


def repeated_words(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many words of each text lie in a window that the text has twice or more.

    `words` holds numbers of words, text after text.  Windows get numbers by doubling: two
    neighbouring windows of half the length make one, so equal numbers are equal words.
    """
    n = len(words)
    starts = np.concatenate(([0], ends[:-1]))
    lengths = ends - starts
    text = np.repeat(np.arange(len(ends)), lengths)
    if n < WINDOW:
        return np.zeros(len(ends), np.int64)
    number, width = words.astype(np.int64), 1
    while width < WINDOW:
        left, right = number[: n - 2 * width + 1], number[width : n - width + 1]
        number = np.unique(left * (int(number.max()) + 1) + right, return_inverse=True)[1]
        width *= 2
    at = np.flatnonzero(text[: n - WINDOW + 1] == text[WINDOW - 1 :])
    if not len(at):
        return np.zeros(len(ends), np.int64)
    key = number[at] * len(ends) + text[at]
    _, which, count = np.unique(key, return_inverse=True, return_counts=True)
    edges = np.zeros(n + 1, np.int64)
    twice = at[count[which] > 1]
    np.add.at(edges, twice, 1)
    np.add.at(edges, twice + WINDOW, -1)
    inside = np.cumsum(edges[:-1]) > 0
    return np.bincount(text[inside], minlength=len(ends)).astype(np.int64)


def block_entropy(tokens: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Mean entropy of each text's blocks, as a share of the most there can be; `size` tokens
    there are in all.  A block of one token has all it can have."""
    starts = np.concatenate(([0], ends[:-1]))
    lengths = ends - starts
    blocks = np.maximum(lengths // BLOCK, 1)
    first = np.concatenate(([0], np.cumsum(blocks)[:-1]))
    text = np.repeat(np.arange(len(ends)), lengths)
    inside = np.arange(len(tokens)) - starts[text]
    block = first[text] + inside * blocks[text] // np.maximum(lengths[text], 1)
    all_blocks = int(blocks.sum())
    found, count = np.unique(block * size + tokens, return_counts=True)
    total = np.bincount(block, minlength=all_blocks)
    own = found // size
    share = count / total[own]
    bits = np.bincount(own, -share * np.log2(share), all_blocks)
    bits = np.where(total > 1, bits / np.log2(np.maximum(total, 2)), 1)
    of_text = np.repeat(np.arange(len(ends)), blocks)
    return np.bincount(of_text, bits, len(ends)) / blocks


class Vocabulary:
    """Words as tokens, worked out once a word."""

    def __init__(self, model: str) -> None:
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=model)
        self.size = self.pieces.get_piece_size()
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.size)])
        self._clear()

    def _clear(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.tokens = np.zeros(0, np.int32)

    def words(self, texts: list[list[bytes]]) -> np.ndarray:
        """Numbers of the words of some texts, which stand for their tokens until the next call."""
        if len(self.numbers) > KEPT_WORDS:
            self._clear()
        known = self.numbers
        out = [known.setdefault(w, len(known)) for words in texts for w in words]
        new = [w.decode() for w in list(known)[len(self.lengths) :]]
        if new:
            cut = self.pieces.encode(new, num_threads=1)
            lengths = np.fromiter(map(len, cut), np.int64, len(cut))
            fresh = np.fromiter(chain.from_iterable(cut), np.int32, int(lengths.sum()))
            self.tokens = np.concatenate((self.tokens, fresh))
            self.lengths = np.concatenate((self.lengths, lengths))
            self.starts = np.cumsum(self.lengths) - self.lengths
        return np.array(out, np.int64)


def measured(texts: list[str], languages: list[str | None], vocabulary: Vocabulary) -> dict:
    """The columns of `_SCHEMA` but the id, for some texts."""
    cut = [t.encode().split() for t in texts]
    words = vocabulary.words(cut)
    n_words = np.fromiter(map(len, cut), np.int64, len(cut))
    ends = np.cumsum(n_words)
    of_word = np.repeat(np.arange(len(texts)), n_words)
    lengths = vocabulary.lengths[words]
    tokens = vocabulary.tokens[ragged(vocabulary.starts[words], lengths)]
    n_tokens = np.bincount(of_word, lengths, len(texts)).astype(np.int64)
    token_ends = np.cumsum(n_tokens)
    of_token = np.repeat(np.arange(len(texts)), n_tokens)
    in_bytes = np.bincount(of_token, vocabulary.is_byte[tokens], len(texts))
    word_chars = np.array([len(t) - sum(map(t.count, WHITE)) for t in texts], np.int64)
    some = n_tokens > 0

    def figure(values: np.ndarray) -> list[float | None]:
        return [float(v) if s else None for v, s in zip(values, some)]

    divisor = np.maximum(n_tokens, 1)
    return {
        "language": [lang or script_of(t) for lang, t in zip(languages, texts)],
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": [sum(map(t.count, SYMBOLS)) for t in texts],
        "n_dup_lines": [repeated_lines(t) for t in texts],
        "n_repeat_words": repeated_words(words, ends),
        "n_tokens": n_tokens,
        "entropy": figure(block_entropy(tokens, token_ends, vocabulary.size)),
        "chars_per_token": figure(word_chars / divisor),
        "byte_share": figure(in_bytes / divisor),
    }


def repeated_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(WHITE)]
    return len(lines) - len(set(lines))


def figures(
    docs: DataFrame,
    model: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """Counts and figures of every text."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(model)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text").to_pylist()
                found = measured(texts, part.column("lang").to_pylist(), vocabulary)
                yield batch_of(_SCHEMA, doc_id=part.column("doc_id").to_pylist(), **found)

    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
    ).mapInArrow(run, _DDL)


# --- bands ------------------------------------------------------------------


def _length() -> Column:
    """Doublings of the number of tokens."""
    return F.floor(F.log2("n_tokens")).cast("int")


_LEVELS = (("language", "length"), ("language",), ())


def _cells(rows: DataFrame) -> DataFrame:
    """How many texts of a language and length have a figure in each cell: a figure has few
    thousand cells, however many texts there are."""
    each = F.array(
        *(F.struct(F.lit(f).alias("figure"), F.round(F.col(f) / CELL).cast("int").alias("cell"))
          for f in _FIGURES)
    )
    return (
        rows.where("n_tokens > 0")
        .select("language", _length().alias("length"), F.inline(each))
        .groupBy("language", "length", "figure", "cell")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _middle(cells: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Median and quartiles of every figure, and the number of texts, by cumulated counts."""
    one = cells.groupBy(*by, "figure", "cell").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy(*by, "figure").orderBy("cell")
    ranked = one.withColumn("upto", F.sum("n").over(upto)).withColumn(
        "texts", F.sum("n").over(Window.partitionBy(*by, "figure"))
    )

    def quantile(q: float) -> Column:
        return F.min(F.when(F.col("upto") >= F.col("texts") * q, F.col("cell")))

    return ranked.groupBy(*by, "figure").agg(
        F.max("texts").alias("texts"),
        (quantile(0.25) * CELL).alias("low"),
        (quantile(0.5) * CELL).alias("median"),
        (quantile(0.75) * CELL).alias("high"),
    )


def bands(rows: DataFrame) -> DataFrame:
    """(language, length, <figure>_low, <figure>_high) for every language and length there is.

    Half of a normal distribution's texts lie within 0.6745 spreads of its median.
    """
    cells = stored(_cells(rows), "fertility-cells")
    wanted = cells.select("language", "length", "figure").distinct()
    out = wanted
    for k, by in enumerate(_LEVELS):
        level = _middle(cells, by).select(
            *by,
            "figure",
            F.when((F.col("texts") >= ENOUGH) | (not by), F.struct("low", "median", "high")).alias(
                f"band_{k}"
            ),
        )
        out = out.join(level, [*by, "figure"])
    band = F.coalesce(*(F.col(f"band_{k}") for k in range(len(_LEVELS))))
    out = out.withColumn("band", band)
    limits = []
    for figure, (below, over) in BANDS.items():
        own = F.col("figure") == figure
        middle = F.col("band.median")
        half = (F.col("band.high") - F.col("band.low")) / 2
        spread = F.greatest(half / 0.6745, F.lit(LEAST[figure]))
        low = middle - below * spread if below is not None else F.lit(float("-inf"))
        high = middle + over * spread if over is not None else F.lit(float("inf"))
        limits.append(F.max(F.when(own, low)).alias(f"{figure}_low"))
        limits.append(F.max(F.when(own, high)).alias(f"{figure}_high"))
    return out.groupBy("language", "length").agg(*limits)


def judged(
    docs: DataFrame,
    model: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """Every text with its counts, figures, bands and verdict.

    `reason` names what spoke first: `words`, `repeats`, a figure, or null for a kept text.
    """
    rows = stored(figures(docs, model, id_col, text_col, lang_col), "fertility")
    limits = stored(
        bands(rows).withColumnsRenamed({"language": "of_language", "length": "of_length"}),
        "fertility-bands",
    )
    if limits.count() <= SENT_BANDS:
        limits = F.broadcast(limits)
    matched = rows.join(
        limits,
        (F.col("language") == F.col("of_language")) & (_length() == F.col("of_length")),
        "left",
    ).drop("of_language", "of_length")
    few = F.col("n_words") < FEWEST_WORDS
    repeats = 100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    reason = F.when(few, "words").when(repeats, "repeats")
    for f in _FIGURES:
        outside = (F.col(f) < F.col(f"{f}_low")) | (F.col(f) > F.col(f"{f}_high"))
        reason = reason.when(outside, f)
    return (
        matched.withColumn("base_failed", few | repeats)
        .withColumn("reason", reason)
        .withColumn("kept", F.col("reason").isNull())
    )
