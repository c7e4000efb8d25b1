"""Packing by best-fit decreasing.

Texts of more tokens than a window are first cut into full windows and a rest; every full
window is a sequence of its own.  The rests and the other texts, longest first, each go to
the open window with the least room that still holds them.  Open windows are kept by the
room they have left; a segment tree over the capacities finds the smallest one that is large
enough and has a window.

Pieces are dealt by a hash to groups of about `GROUP` pieces, and each group is packed by one
task: the tightest fit among so many windows leaves next to no room, and groups stay of one
size however large the corpus is.

Defined cases: a null or empty text is the end token alone; a null id is kept; repeated rows
are packed each.  Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratebook.llm.common import batch_of, prepare, slices, stored, texts
from ratebook.llm.tokens import WordBpe, encoder

WINDOW = 2048
#: The token after every text.
END = 1
#: Pieces packed together.
GROUP = 50_000

_PIECES = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
     ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))]
)
_PIECE_COLUMNS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _cut(path: str, window: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(WordBpe, path)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, counts = words.encode(part.column("text"))
                # the end token after every text
                ids = np.insert(ids, np.cumsum(counts), END).astype("<u4")
                totals = counts + 1
                first = np.cumsum(totals) - totals
                pieces = -(-totals // window)
                owner = np.repeat(np.arange(len(totals)), pieces)
                turn = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = turn * window
                length = np.minimum(window, totals[owner] - start)
                begin = first[owner] + start
                raw = memoryview(ids.tobytes())
                crc = [
                    zlib.crc32(raw[4 * b : 4 * (b + n)])
                    for b, n in zip(begin.tolist(), length.tolist())
                ]
                columns = dict(
                    doc_id=part.column("doc_id").take(pa.array(owner)),
                    start=start,
                    length=length,
                    ids_crc32=crc,
                    doc_tokens=totals[owner],
                )
                if keep_ids:
                    columns["ids"] = pa.ListArray.from_arrays(
                        pa.array(np.concatenate((begin, begin[-1:] + length[-1:])), pa.int32()),
                        pa.array(ids.astype(np.int32)),
                    )
                    yield batch_of(_PIECES, **columns)
                else:
                    yield batch_of(pa.schema(list(_PIECES)[:-1]), **columns)

    return run


class Rooms:
    """Open windows by room left; a segment tree over the rooms 0..size."""

    def __init__(self, size: int) -> None:
        self.leaves = 1 << size.bit_length()
        self.filled = bytearray(2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(size + 1)]

    def put(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        node = self.leaves + room
        while node and not self.filled[node]:
            self.filled[node] = 1
            node >>= 1

    def tightest(self, need: int) -> int | None:
        """The smallest room of at least `need` that a window has."""
        node = self.leaves + need
        if not self.filled[node]:
            # up to the first right neighbour that has a window, then down its left edge
            while node > 1 and (node & 1 or not self.filled[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.filled[2 * node] else 2 * node + 1
        return node - self.leaves

    def take(self, room: int) -> int:
        window = self.windows[room].pop()
        node = self.leaves + room
        if not self.windows[room]:
            self.filled[node] = 0
            node >>= 1
            while node and not (self.filled[2 * node] or self.filled[2 * node + 1]):
                self.filled[node] = 0
                node >>= 1
        return window


def best_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, offset) of every piece; none is longer than `size`."""
    window, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    rooms, opened = Rooms(size), 0
    order = np.argsort(-lengths, kind="stable")
    for k, need in zip(order.tolist(), lengths[order].tolist()):
        room = rooms.tightest(need) if need < size else None
        if room is None:
            room, at = size, opened
            opened += 1
        else:
            at = rooms.take(room)
        window[k], offset[k] = at, size - room
        if room > need:
            rooms.put(room - need, at)
    return window, offset


def _pack(window: int):
    def run(key, table):
        table = table.sort_by(
            [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"),
             ("ids_crc32", "ascending")]
        )
        at, offset = best_fit_decreasing(table.column("length").to_numpy(), window)
        sequence = (key[0].as_py() << 32) + at
        return (
            table.drop_columns(["pack"])
            .append_column("sequence_id", pa.array(sequence, pa.int64()))
            .append_column("offset", pa.array(offset, pa.int64()))
        )

    return run


def pieces(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    keep_ids: bool = True,
) -> DataFrame:
    """Pieces of at most a window: doc_id, start, length, ids_crc32, doc_tokens and the ids."""
    prepare(docs.sparkSession)
    columns = _PIECE_COLUMNS + (", ids array<int>" if keep_ids else "")
    return texts(docs, id_col, text_col).mapInArrow(_cut(path, window, keep_ids), columns)


def pack(cut: DataFrame, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """The pieces with sequence_id and offset."""
    cut = stored(cut, "pieces")
    groups = max(1, -(-cut.count() // group))
    dealt = cut.withColumn(
        "pack",
        F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", F.monotonically_increasing_id()),
               F.lit(groups)),
    )
    columns = ", ".join(f"{n} {t}" for n, t in cut.dtypes)
    return dealt.groupBy("pack").applyInArrow(
        _pack(window), f"{columns}, sequence_id long, offset long"
    )
