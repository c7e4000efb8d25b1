"""Removal of repeated byte strings, by suffix arrays over the places where texts part.

A byte goes if a string of `length` bytes that covers it also starts earlier: in a text of
smaller id, or earlier in the same text.  Every string of that length ("window") counts, at
every byte.

1. Anchors.  A window's anchor is its least hashed `KGRAM`-gram, the leftmost of equals.
   Equal windows have equal anchors at the same distance, so windows meet under the anchor's
   hash.  Neighbouring windows with one anchor make a block: some 130 bytes.
2. Under one anchor, blocks of equal content (two independent 64-bit hashes) repeat each
   other whole: all but the first are removed.  Each task does that for its own texts before
   the shuffle, so a text with any number of copies sends few.  Anchors with a single block,
   as most are, end here.
3. What is left are the first blocks of anchors with several: the places where a repeated
   passage begins or ends, or where copies differ.  Their bytes are fetched, windows whose
   hash nothing else has are trimmed away, equal remainders are merged, and a suffix array
   (`lyndon`) over the rest puts equal windows next to each other.  They are compared byte by
   byte; all but the first are removed.  An anchor with more than `MANY` such blocks is dealt
   to parts of about `MANY`, each judged like an anchor.  The first windows of the parts are
   counted by (anchor, distance from it, hash) in Spark, those that no other part has are
   dropped, and the rest meet in groups of about `MANY`, each with the first of its windows.
   No Python task holds the whole of such an anchor.
4. Removed windows are merged per text.

A text of more than `SEGMENT` bytes is read in overlapping segments, which cuts blocks but
loses no window.

Defined cases: a null or empty text has nothing to remove; a null id counts as larger than
all others; rows that share an id are no earlier than each other at equal starts, so repeated
rows get equal results; columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratebook.llm.common import NO_ID, batch_of, keyed, prepare, ragged, real_id, slices, stored, whole
from ratebook.llm.lyndon import suffix_array

LENGTH = 100
KGRAM = 32
#: Bytes hashed at once; positions must fit into the low bits of `_POSITION`.
SEGMENT = 1 << 19
_POSITION = np.uint64((1 << 20) - 1)
#: Anchors that a task keeps before it merges and sends them.
KEPT_ANCHORS = 1_500_000
#: Bytes of block text that go into one suffix array, whole anchors at a time.
SORTED_BYTES = 200_000
#: Different blocks of one anchor that still meet in one task.
MANY = 2048

_U = np.uint64
_BASES = (_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F))
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    if int(base) not in _POWERS or len(_POWERS[int(base)][0]) < n:
        found = []
        for factor in (base, _U(pow(int(base), -1, 1 << 64))):
            steps = np.full(max(n, 1 << 16), factor, np.uint64)
            steps[0] = 1
            found.append(np.multiply.accumulate(steps))
        _POWERS[int(base)] = tuple(found)
    up, down = _POWERS[int(base)]
    return up[:n], down[:n]


class Rolling:
    """Hashes of any stretch of a buffer, equal for equal stretches."""

    def __init__(self, data: np.ndarray, base: np.uint64) -> None:
        up, self.down = _powers(base, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data + _U(1)) * up[:-1], out=self.sums[1:])

    def grams(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        return mixed((self.sums[k:] - self.sums[:-k]) * self.down[:n])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> _U(29))
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(32)
    return h


def blocks(data: np.ndarray, offsets: np.ndarray, length: int, kgram: int):
    """(text, anchor, start, end, anchor's hash, content hash) of every block.

    `offsets` cut the buffer into texts; places are relative to the buffer.
    """
    n = len(data)
    wide = data.astype(np.uint64)
    grams = Rolling(wide, _BASES[0]).grams(kgram)
    # order by the upper bits, then from the left
    least = (grams & ~_POSITION) | np.arange(len(grams), dtype=np.uint64)
    window, span = length - kgram + 1, 1
    while 2 * span <= window:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if window > span:
        rest = window - span
        least = np.minimum(least[:-rest], least[rest:])
    anchor = (least & _POSITION).astype(np.int64)
    # windows that stay inside their text
    sizes = np.diff(offsets)
    inside = np.maximum(sizes - length + 1, 0)
    starts = ragged(offsets[:-1], inside)
    owner = np.repeat(np.arange(len(sizes)), inside)
    at = anchor[starts]
    first = np.flatnonzero(
        np.concatenate(([True], (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])))
    )
    last = np.concatenate((first[1:], [len(at)])) - 1
    begin, end, at = starts[first], starts[last] + length, at[first]
    content = Rolling(wide, _BASES[1]).of(begin, end)
    content ^= (at - begin).astype(np.uint64) * _U(0x9FB21C651E98DF25)
    content ^= (end - begin).astype(np.uint64) * _U(0xD6E8FEB86659FD93)
    assert n <= int(_POSITION)
    return owner[first], at, begin, end, grams[at], mixed(content)


#: A block is where its anchor is, and how far it reaches before and after it, in one number;
#: a run that is removed already has its start, negative, and its size as `content`.
_FOUND = pa.schema(
    [(c, pa.int64()) for c in ("key", "content", "did", "sig", "place")]
)
_FOUND_COLUMNS = "key long, content long, did long, sig long, place long"
_REACH = 12


def _unpacked(place: Column) -> tuple[Column, Column, Column]:
    """(position, before, after) of a block's place."""
    mask = F.lit((1 << _REACH) - 1)
    return (
        F.shiftright(place, 2 * _REACH),
        F.shiftright(place, _REACH).bitwiseAND(mask),
        place.bitwiseAND(mask),
    )


def merged(start: np.ndarray, end: np.ndarray, owner: np.ndarray):
    """Maximal runs of each owner, from its intervals."""
    order = np.lexsort((start, owner))
    start, end, owner = start[order], end[order], owner[order]
    if not len(start):
        return start, end, owner
    # running maximum of the ends within an owner: owners are numbered upwards
    shift = owner.astype(np.int64) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + shift) - shift
    fresh = np.concatenate(([True], (owner[1:] != owner[:-1]) | (start[1:] > reach[:-1])))
    at = np.flatnonzero(fresh)
    return start[at], reach[np.concatenate((at[1:], [len(start)])) - 1], owner[at]


class _Anchors:
    """A task's blocks; those that repeat an earlier one of the same task are removed."""

    def __init__(self) -> None:
        self.parts: list[list[np.ndarray]] = []
        self.count = 0

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(list(columns))
        self.count += len(columns[0])

    def drain(self) -> Iterator[pa.RecordBatch]:
        if not self.count:
            return
        key, content, did, sig, pos, begin, end = (
            np.concatenate(p) for p in zip(*self.parts)
        )
        self.parts, self.count = [], 0
        order = np.lexsort((pos, did, content, key))
        key, content, did, sig, pos, begin, end = (
            x[order] for x in (key, content, did, sig, pos, begin, end)
        )
        fresh = np.concatenate(
            ([True], (key[1:] != key[:-1]) | (content[1:] != content[:-1]))
        )
        head = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
        first = (did == did[head]) & (pos == pos[head])
        gone = ~first
        texts, owner = np.unique(np.stack((did[gone], sig[gone])), axis=1, return_inverse=True)
        start, stop, owner = merged(begin[gone], end[gone], owner.reshape(-1))
        kept = dict(
            key=key[first], content=content[first], did=did[first], sig=sig[first],
            place=(pos << 2 * _REACH | (pos - begin) << _REACH | (end - pos))[first],
        )
        removed = dict(
            key=start * 31 + texts[0][owner], content=stop - start, did=texts[0][owner],
            sig=texts[1][owner], place=-1 - start,
        )
        for columns in (kept, removed):
            for k in range(0, len(columns["key"]), 50_000):
                yield batch_of(_FOUND, **{n: c[k : k + 50_000] for n, c in columns.items()})


def _anchors(length: int, kgram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = _Anchors()
        for batch in batches:
            for part in slices(batch, "text", SEGMENT // 2):
                text = part.column("text").cast(pa.large_string())
                offsets = np.frombuffer(text.buffers()[1], np.int64)
                offsets = offsets[text.offset : text.offset + len(text) + 1]
                raw = text.buffers()[2]
                data = np.frombuffer(raw, np.uint8) if raw else np.zeros(0, np.uint8)
                data = data[offsets[0] : offsets[-1]]
                offsets = offsets - offsets[0]
                did, sig = (part.column(c).to_numpy() for c in ("did", "sig"))
                step = SEGMENT - length
                for low in range(0, max(1, len(data) - length + 1), step):
                    piece = data[low : low + SEGMENT]
                    if len(piece) < length:
                        continue
                    cut = np.clip(offsets - low, 0, len(piece))
                    if not np.any(np.diff(cut) >= length):
                        continue
                    owner, at, begin, end, key, content = blocks(piece, cut, length, kgram)
                    base = low - offsets[owner]
                    kept.add(
                        key.view(np.int64), content.view(np.int64), did[owner], sig[owner],
                        at + base, begin + base, end + base,
                    )
                if kept.count > KEPT_ANCHORS:
                    yield from kept.drain()
        yield from kept.drain()

    return run


_EDGES_COLUMNS = "key long, did long, sig long, start long, ahead long, bytes binary"
_EDGES = pa.schema(
    [("key", pa.int64()), ("did", pa.int64()), ("sig", pa.int64()), ("start", pa.int64()),
     ("ahead", pa.int64()), ("bytes", pa.binary())]
)
#: `parts`: to how many groups the blocks of the anchor are dealt.
_FETCHED = _EDGES.append(pa.field("parts", pa.int64()))


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as small as they get before they are shuffled."""
    schema = pa.schema([("did", pa.int64()), ("sig", pa.int64()), ("packed", pa.binary())])
    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        yield batch_of(
            schema,
            did=batch.column("did"),
            sig=batch.column("sig"),
            packed=[press.compress(t.as_buffer()) for t in batch.column("text")],
        )


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the blocks that a text has."""
    press = zstandard.ZstdDecompressor()
    for batch in batches:
        out = {name: [] for name in _FETCHED.names}
        for did, sig, packed, edges in zip(
            *(batch.column(c).to_pylist() for c in ("did", "sig", "packed", "edges"))
        ):
            raw = press.decompress(packed)
            for edge in edges:
                start = edge["start"]
                block = raw[start : edge["end"]]
                row = (edge["key"], did, sig, start, edge["ahead"], block, edge["parts"])
                for name, value in zip(_FETCHED.names, row):
                    out[name].append(value)
        yield batch_of(_FETCHED, **out)


def _windows_of(raw: list[bytes], length: int):
    """(all blocks joined, where each begins, place, block and hash of every window)."""
    sizes = np.array([len(b) for b in raw], np.int64)
    joined = b"".join(raw)
    begin = np.cumsum(sizes) - sizes
    count = sizes - length + 1
    at = ragged(begin, count)
    owner = np.repeat(np.arange(len(raw)), count)
    hashed = Rolling(np.frombuffer(joined, np.uint8).astype(np.uint64), _BASES[1]).of(
        at, at + length
    )
    return joined, begin, at, owner, hashed


_REMOVED = pa.schema(
    [("did", pa.int64()), ("sig", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]
)


def repeated_windows(table: pa.Table, length: int) -> pa.RecordBatch:
    """Windows of blocks that another block of the same anchor has earlier."""
    key, did, sig, start, ahead = (
        table.column(c).to_numpy() for c in ("key", "did", "sig", "start", "ahead")
    )
    raw = table.column("bytes").to_pylist()
    joined, begin, at, owner, hashed = _windows_of(raw, length)
    # windows that meet another one under their anchor, at the same distance from it
    distance = ahead[owner] - (at - begin[owner])
    order = np.lexsort((hashed, distance, key[owner]))
    k, d, h = key[owner][order], distance[order], hashed[order]
    same = (k[1:] == k[:-1]) & (d[1:] == d[:-1]) & (h[1:] == h[:-1])
    met = np.zeros(len(at), bool)
    met[order[1:][same]] = True
    met[order[:-1][same]] = True
    met = np.flatnonzero(met)
    # trim every block to its first and last such window, then merge equal ones
    first = np.flatnonzero(np.concatenate(([True], owner[met][1:] != owner[met][:-1])))[: len(met)]
    last = np.concatenate((first[1:], [len(met)]))[: len(first)] - 1
    who, low, high = owner[met[first]], at[met[first]], at[met[last]] + length
    gone: list[tuple[int, int, int, int]] = []
    groups: dict[int, dict[tuple[int, bytes], list[int]]] = {}
    for n, (w, a, b) in enumerate(zip(who.tolist(), low.tolist(), high.tolist())):
        within = groups.setdefault(int(key[w]), {})
        within.setdefault((int(ahead[w] - (a - begin[w])), joined[a:b]), []).append(n)
    sorted_blocks: list[tuple[int, int, bytes]] = []
    for classes in groups.values():
        for (_, content), members in classes.items():
            places = [(int(did[who[n]]), int(start[who[n]] + low[n] - begin[who[n]]), n)
                      for n in members]
            head = min(places)[:2]
            for d_, s_, n in places:
                if (d_, s_) != head:
                    gone.append((d_, int(sig[who[n]]), s_, s_ + len(content)))
            if len(classes) > 1:
                sorted_blocks += [
                    (d_, s_, int(sig[who[n]]), content) for d_, s_, n in places if (d_, s_) == head
                ]
    if sorted_blocks:
        gone += _sorted_windows(sorted_blocks, length)
    columns = list(zip(*gone)) if gone else [[]] * 4
    return batch_of(_REMOVED, **dict(zip(_REMOVED.names, map(list, columns))))


def _sorted_windows(found: list[tuple[int, int, int, bytes]], length: int):
    """Of equal windows, next to each other in the suffix array, all but the first."""
    text: list[int] = []
    block_of: list[int] = []
    for n, (*_, content) in enumerate(found):
        text += [b + 1 for b in content]
        text.append(0)
        block_of += [n] * (len(content) - length + 1) + [-1] * length
    raw = b"\x00".join(content for *_, content in found)
    begin, at = [], 0
    for *_, content in found:
        begin.append(at)
        at += len(content) + 1
    gone = []
    group: list[tuple[int, int, int]] = []
    before = None

    def close():
        if len(group) > 1:
            head = min(g[:2] for g in group)
            gone.extend((d, s, a, a + length) for d, a, s in group if (d, a) != head)

    for i in suffix_array(text):
        n = block_of[i]
        if n < 0:
            continue
        window = raw[i : i + length]
        if window != before:
            close()
            group, before = [], window
        did, start, sig, _ = found[n]
        group.append((did, start + i - begin[n], sig))
    close()
    return gone


def first_windows(table: pa.Table, length: int) -> pa.RecordBatch:
    """What is removed within parts of anchors (without bytes, `ahead` is the end), and the
    windows that are first there, each as a block under its anchor, distance and hash."""
    gone = repeated_windows(table, length)
    anchor, did, sig, start, ahead = (
        table.column(c).to_numpy() for c in ("anchor", "did", "sig", "start", "ahead")
    )
    joined, begin, at, owner, hashed = _windows_of(table.column("bytes").to_pylist(), length)
    offset = at - begin[owner]
    distance = ahead[owner] - offset
    key = mixed(anchor.view(np.uint64)[owner] + distance.astype(np.uint64) * _BASES[0])
    key = mixed(key ^ hashed).view(np.int64)
    did, sig, start = did[owner], sig[owner], start[owner] + offset
    part = table.column("key").to_numpy()[owner]
    order = np.lexsort((start, did, key, part))
    k, p = key[order], part[order]
    fresh = np.concatenate(([True], (k[1:] != k[:-1]) | (p[1:] != p[:-1])))
    head = order[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
    left = order[(did[order] == did[head]) & (start[order] == start[head])]
    return batch_of(
        _EDGES,
        key=np.concatenate((np.zeros(len(gone), np.int64), key[left])),
        did=np.concatenate((gone.column("did").to_numpy(), did[left])),
        sig=np.concatenate((gone.column("sig").to_numpy(), sig[left])),
        start=np.concatenate((gone.column("start").to_numpy(), start[left])),
        ahead=np.concatenate((gone.column("end").to_numpy(), distance[left])),
        bytes=[None] * len(gone) + [joined[a : a + length] for a in at[left].tolist()],
    )


def _sort_edges(length: int, sorted_bytes: int, judge=repeated_windows):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches come ordered by key; whole keys are taken until there are enough bytes."""
        waiting: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            waiting.append(batch)
            size += batch.get_total_buffer_size()
            if size < sorted_bytes:
                continue
            table = pa.Table.from_batches(waiting).combine_chunks()
            keys = table.column("key").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield from _runs(table.slice(0, cut), length, sorted_bytes, judge)
                table = table.slice(cut)
            waiting = table.to_batches()
            size = sum(len(b) for b in table.column("bytes").to_pylist())
        if waiting:
            yield from _runs(pa.Table.from_batches(waiting), length, sorted_bytes, judge)

    return run


def _runs(
    table: pa.Table, length: int, sorted_bytes: int, judge
) -> Iterator[pa.RecordBatch]:
    keys = table.column("key").to_numpy()
    sizes = np.cumsum(pc.binary_length(table.column("bytes")).to_numpy())
    start = 0
    while start < len(keys):
        reached = sizes[start - 1] if start else 0
        end = min(int(np.searchsorted(sizes, reached + sorted_bytes)) + 1, len(keys))
        end = int(np.searchsorted(keys, keys[end - 1], side="right"))
        yield judge(table.slice(start, end - start), length)
        start = end


def _judged(rows: DataFrame, length: int, kgram: int) -> DataFrame:
    """Blocks that are `gone` as a whole, and the first ones of anchors with several."""
    found = rows.mapInArrow(_anchors(length, kgram), _FOUND_COLUMNS).repartition("key")
    found = found.withColumn("removed", F.col("place") < 0)
    anchor = Window.partitionBy("key", "removed")
    by_place = Window.partitionBy("key", "removed", "content").orderBy("did", "place")
    judged = stored(
        found.withColumn("rank", F.rank().over(by_place))
        .withColumn("least", F.min("content").over(anchor))
        .withColumn("most", F.max("content").over(anchor))
        .withColumn("firsts", F.count(F.when(F.col("rank") == 1, 1)).over(anchor))
        .withColumn("gone", F.col("removed") | (F.col("rank") > 1))
        .where("gone or least < most")
        .withColumn("parts", F.ceil(F.col("firsts") / F.lit(MANY)))
        .select("gone", "removed", "parts", "key", "content", "did", "sig", "place"),
        "blocks",
    )
    position, before, after = _unpacked(F.col("place"))
    return judged.withColumns(
        {
            "start": F.when(F.col("removed"), -1 - F.col("place")).otherwise(position - before),
            "end": F.when(F.col("removed"), F.col("content") - 1 - F.col("place")).otherwise(
                position + after
            ),
            "ahead": before,
        }
    )


def _grouped(edges: DataFrame) -> DataFrame:
    return edges.repartition("key").sortWithinPartitions("key")


def _parting(rows: DataFrame, judged: DataFrame, length: int) -> tuple[DataFrame, list[DataFrame]]:
    """The bytes of the blocks left to compare, those of one key together; and what the parts
    of crowded anchors have removed already."""
    edges = (
        judged.where("not gone")
        .groupBy("did", "sig")
        # rows that repeat id and text repeat their blocks
        .agg(F.collect_set(F.struct("key", "start", "end", "ahead", "parts")).alias("edges"))
    )
    fetched = (
        rows.where(F.octet_length("text") >= length)
        .mapInArrow(_compressed, "did long, sig long, packed binary")
        .join(edges, ["did", "sig"])
        .select("did", "sig", "packed", "edges")
        .mapInArrow(_fetch, f"{_EDGES_COLUMNS}, parts long")
    )
    if judged.where("not gone and parts > 1").isEmpty():
        return _grouped(fetched.drop("parts")), []
    fetched = stored(fetched, "edges")
    crowded = (
        fetched.where("parts > 1")
        .dropDuplicates(["key", "did", "sig", "start"])
        .withColumn("anchor", F.col("key"))
        .withColumn("part", F.pmod(F.xxhash64("did", "sig", "start"), "parts"))
        .withColumn("key", F.xxhash64("key", "part"))
    )
    judge = _sort_edges(length, SORTED_BYTES, first_windows)
    firsts = stored(
        _grouped(crowded.drop("part", "parts")).mapInArrow(judge, _EDGES_COLUMNS), "windows"
    )
    gone = firsts.where("bytes is null").select("did", "sig", "start", F.col("ahead").alias("end"))
    light = fetched.where("parts = 1").drop("parts")
    return _grouped(light.unionByName(_shared(firsts.where("bytes is not null"), MANY))), [gone]


def _shared(windows: DataFrame, many: int) -> DataFrame:
    """Windows that meet others of their key, in groups of about `many`."""
    found = stored(
        windows.groupBy("key")
        .agg(F.count("*").alias("n"), F.min(F.struct("did", "start", "sig")).alias("first"))
        .where("n > 1"),
        "shared",
    )
    groups = F.ceil(F.col("n") / F.lit(many)).cast("int")
    own = F.pmod(F.xxhash64("did", "sig", "start"), groups).cast("int")
    # the first goes to all groups of its windows
    group = F.when(
        F.struct("did", "start", "sig") == F.col("first"), F.sequence(F.lit(0), groups - 1)
    ).otherwise(F.array(own))
    return (
        windows.join(found, "key")
        .withColumn("group", F.explode(group))
        .withColumn("key", F.xxhash64("key", "group"))
        .select(_EDGES.names)
    )


def repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    kgram: int = KGRAM,
) -> DataFrame:
    """(did, sig, spans): the removed byte runs of every text that has some."""
    if not 0 < kgram <= length < 1 << _REACH:
        raise ValueError("anchors are at most as long as the strings, and those under 4096 bytes")
    prepare(docs.sparkSession)
    rows = keyed(docs, id_col, text_col)
    judged = _judged(rows, length, kgram)
    whole = judged.where("gone").select("did", "sig", "start", "end")
    edges, within = _parting(rows, judged, length)
    for part in within:
        whole = whole.unionByName(part)
    partial = edges.mapInArrow(
        _sort_edges(length, SORTED_BYTES), "did long, sig long, start long, end long"
    )
    return (
        whole.unionByName(partial)
        .groupBy("did", "sig")
        .agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    )


def kept_parts(raw: bytes, spans: list[dict] | None) -> tuple[list[bytes], int]:
    """What is left, and how many maximal runs went."""
    if not spans:
        return [raw], 0
    start, end, _ = merged(
        np.array([s["start"] for s in spans], np.int64),
        np.array([s["end"] for s in spans], np.int64),
        np.zeros(len(spans), np.int64),
    )
    cuts = [0, *(x for pair in zip(start.tolist(), end.tolist()) for x in pair), len(raw)]
    return [raw[a:b] for a, b in zip(cuts[::2], cuts[1::2])], len(start)


def digests(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), a row for each row of `docs`."""
    spans = repeats(docs, **options)
    schema = pa.schema(
        [("did", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
         ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for did, packed, found in zip(
                *(batch.column(c).to_pylist() for c in ("did", "packed", "spans"))
            ):
                raw = press.decompress(packed)
                parts, runs = kept_parts(raw, found)
                left = b"".join(parts)
                out.append(
                    (did, len(raw), len(raw) - len(left), runs, hashlib.sha256(left).hexdigest())
                )
            columns = list(zip(*out)) if out else [[]] * 5
            yield batch_of(schema, **dict(zip(schema.names, map(list, columns))))

    rows = keyed(docs, options.get("id_col", "doc_id"), options.get("text_col", "text"))
    return (
        rows.mapInArrow(_compressed, "did long, sig long, packed binary")
        .join(spans, ["did", "sig"], "left")
        .select("did", "packed", "spans")
        .mapInArrow(
            run, "did long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
        )
        .select(real_id(), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    )


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """The rows of `docs` with the repeated bytes taken out of their texts.

    Bytes of a character of which a part was removed go as well.
    """
    spans = repeats(docs, id_col, text_col, **options)

    @F.pandas_udf("string")
    def left(text, found):
        import pandas as pd

        return pd.Series(
            [
                t
                if t is None or s is None
                else b"".join(kept_parts(t.encode(), list(s))[0]).decode(errors="ignore")
                for t, s in zip(text, found)
            ]
        )

    text = F.col("row").getField(text_col)
    cut = F.when(F.col("spans").isNotNull(), left(text, F.col("spans")))
    return (
        whole(docs, id_col, text_col)
        .join(spans, ["did", "sig"], "left")
        .withColumn("row", F.col("row").withField(f"`{text_col}`", F.coalesce(cut, text)))
        .select("row.*")
    )
