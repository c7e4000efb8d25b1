"""Token counts by overlap resynchronisation.

Ordinary texts are counted whole.  A huge text is cut into chunks that overlap, and every
chunk is encoded by itself, with offsets.  Inside an overlap the left and the right encoding
are compared: where both start the same token, as the first of a pre-tokenizer's piece, at
the same place, and far enough from either chunk's cut end, the rest of the text is read the
same way by both, so they can be spliced there.  Counting needs no more than that:

    tokens = sum of the chunks' tokens
             - for each seam, the left chunk's tokens from the splice on
             - for each seam, the right chunk's tokens before the splice

Why a splice holds: a piece of the pre-tokenizer depends on the text from its start and on
one character after its end, never on what came before, and a special string is found by
both chunks when it lies `GUARD` characters inside both.

Where an overlap holds no such place (one piece covers it), the text is cut anew with
longer chunks and overlaps, at last into one chunk.

Defined cases: a null text is empty; an empty text has no tokens; a null id is kept;
repeated rows are counted each.  Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratebook.llm.common import batch_of, prepare, slices, stored, texts
from ratebook.llm.tokens import ByteBpe, encoder, library

#: Characters of a chunk, and of the overlap with the next one.
CHUNK = 1 << 15
OVERLAP = 1 << 9
#: A splice is so many characters away from the cut ends of both chunks.
GUARD = 64
#: How much longer chunks and overlaps get when a seam fails.
WIDER = 8

_SEAMS = pa.schema(
    [("row", pa.int64()), ("seam", pa.int64()), ("at", pa.list_(pa.int64())),
     ("token", pa.list_(pa.int64())), ("index", pa.list_(pa.int64())),
     ("tokens", pa.int64()), ("right", pa.bool_())]
)
_LIBRARIES: dict[str, object] = {}


def _library(path: str):
    if path not in _LIBRARIES:
        _LIBRARIES[path] = library(path)
    return _LIBRARIES[path]


def starts(encoding) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offset, token id, index) of every token that begins a piece."""
    words = np.array([-1 if w is None else w for w in encoding.word_ids], np.int64)
    begins = np.flatnonzero(np.diff(words, prepend=-2) != 0)
    offsets = np.array(encoding.offsets, np.int64).reshape(-1, 2)
    return offsets[begins, 0], np.array(encoding.ids, np.int64)[begins], begins


def splice(left: dict, right: dict, low: int, high: int) -> tuple[int, int] | None:
    """Indexes of the first token that both encodings start in [low, high)."""
    places = {
        (a, t): i for a, t, i in zip(left["at"], left["token"], left["index"]) if low <= a < high
    }
    for a, t, i in zip(right["at"], right["token"], right["index"]):
        if (a, t) in places:
            return places[a, t], i
    return None


def _encode_chunks(path: str, size: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _library(path)
        for batch in batches:
            out = {name: [] for name in _SEAMS.names}
            for row in batch.to_pylist():
                encoding = tokenizer.encode(row["piece"], add_special_tokens=False)
                tokens = len(encoding.ids)
                at, token, index = starts(encoding)
                at = at + row["k"] * size
                for right in (True, False):
                    seam = row["k"] - 1 if right else row["k"]
                    edge = (seam + 1) * size
                    near = (at >= edge + GUARD) & (at < edge + overlap - GUARD)
                    if right and not row["k"]:
                        # the first chunk has no seam on its left: its tokens count here
                        near = np.zeros(len(at), bool)
                    for name, value in (
                        ("row", row["row"]), ("seam", seam), ("at", at[near]),
                        ("token", token[near]), ("index", index[near]),
                        ("tokens", tokens), ("right", right),
                    ):
                        out[name].append(value)
            yield batch_of(_SEAMS, **out)

    return run


_SPLICED = "row long, tokens long, failed boolean"


def _splice_seams(size: int, overlap: int):
    def run(key, table):
        rows = table.to_pylist()
        left = [r for r in rows if not r["right"]]
        right = [r for r in rows if r["right"]]
        edge = (key[1].as_py() + 1) * size
        failed = False
        tokens = sum(r["tokens"] for r in left)
        if left and right:
            found = splice(left[0], right[0], edge + GUARD, edge + overlap - GUARD)
            failed = found is None
            if found:
                tokens -= left[0]["tokens"] - found[0] + found[1]
        return pa.table(
            {"row": [key[0].as_py()], "tokens": pa.array([tokens], pa.int64()), "failed": [failed]}
        )

    return run


def _chunks(rows: DataFrame, size: int, overlap: int) -> DataFrame:
    """(row, k, piece): a text shorter than a chunk and its overlap is one piece."""
    length = F.length("text")
    pieces = F.greatest(F.lit(1), F.ceil((length - overlap) / F.lit(size)).cast("int"))
    return rows.select(
        "row", "text", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("k"), pieces.alias("n")
    ).select(
        "row",
        F.col("k").cast("long").alias("k"),
        F.expr(
            f"substring(text, k * {size} + 1, if(k = n - 1, length(text), {size + overlap}))"
        ).alias("piece"),
    )


def count_huge(rows: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """(row, n_tokens) of texts with a unique `row`."""
    done: DataFrame | None = None
    while True:
        seams = (
            _chunks(rows, chunk, overlap)
            .repartition(F.col("row"), F.col("k"))
            .mapInArrow(
                _encode_chunks(path, chunk, overlap),
                "row long, seam long, at array<long>, token array<long>, index array<long>,"
                " tokens long, right boolean",
            )
            # the first chunk's left side is no seam
            .where(~((F.col("seam") < 0) & F.col("right")))
        )
        spliced = (
            seams.groupBy("row", "seam")
            .applyInArrow(_splice_seams(chunk, overlap), _SPLICED)
            .groupBy("row")
            .agg(F.sum("tokens").alias("n_tokens"), F.max("failed").alias("failed"))
        )
        spliced = stored(spliced, "token-seams")
        good = spliced.where(~F.col("failed")).select("row", "n_tokens")
        done = good if done is None else done.unionByName(good)
        bad = spliced.where("failed").select("row")
        if bad.isEmpty():
            return done
        rows = rows.join(bad, "row", "left_semi")
        chunk, overlap = chunk * WIDER, overlap * WIDER


def _count_small(path: str):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = encoder(ByteBpe, path)
        for batch in batches:
            for part in slices(batch, "text"):
                text = part.column("text")
                counts = counter.encode(text, count_only=True)[1]
                yield batch_of(
                    schema,
                    doc_id=part.column("doc_id"),
                    n_bytes=pc.binary_length(text),
                    n_tokens=counts,
                )

    return run


def count_tokens(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens), a row for each row of `docs`."""
    if overlap <= 2 * GUARD or chunk < 2 * overlap:
        raise ValueError("chunks are at least two overlaps long, an overlap more than two guards")
    prepare(docs.sparkSession)
    plain = texts(docs, id_col, text_col)
    huge = F.length("text") > chunk + overlap
    small = plain.where(~huge).mapInArrow(
        _count_small(path), "doc_id long, n_bytes long, n_tokens long"
    )
    long_texts = stored(
        plain.where(huge).withColumn("row", F.monotonically_increasing_id()), "huge-texts"
    )
    counted = count_huge(long_texts.select("row", "text"), path, chunk, overlap)
    long_counts = long_texts.select(
        "row", "doc_id", F.octet_length("text").cast("long").alias("n_bytes")
    ).join(counted, "row")
    return small.unionByName(long_counts.drop("row"))
