"""Near duplicates by a chosen-path join on word shingles.

1. A text is the set of its five-word shingles.  Equal sets are one record with a weight.
2. A record is embedded as `T` tokens (i, least hash of its set under the i-th function); two
   records share a token with the probability of their similarity.
3. Each run starts from all records and splits them on sampled tokens: a node picks
   coordinates, 1 / `SIMILARITY` on average, and a record goes on to the child of its token
   there.  Nodes of at most `LEAF` records are compared pair by pair; larger ones are split
   again.  Nodes still larger after `DEPTH` levels are compared in blocks.  Runs are repeated
   until pairs at the threshold meet with probability `RECALL`.
4. A leaf yields candidate links, of which a task keeps a spanning forest: what one node
   sends on grows with its records, not with their pairs.
5. Within each candidate class (a component of those links) all sets are compared exactly, in
   blocks if there are many.  A record's number of links is counted there; a spanning forest
   of the true links gives the classes.

Words are those between white space, in lower case.  A text of one to four words has one
shingle of all of them; one without words links to nothing.

Defined cases: a null text is empty; a null id is kept and counts as larger than all others;
repeated rows are copies of each other; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratebook.llm.common import batch_of, keyed, prepare, real_id, slices, stored, whole
from ratebook.llm.components import components
from ratebook.llm.suffix_dedup import _BASES, Rolling, mixed

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.999
T = 64
LEAF = 256
DEPTH = 3
#: Records of a class that are compared in one matrix.
BLOCK = 256

_U = np.uint64


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Hashes of the distinct shingles of a text."""
    plain = " ".join(text.lower().split()).encode()
    if not plain:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(plain, np.uint8)
    blanks = np.flatnonzero(data == 32)
    starts = np.concatenate(([0], blanks + 1))
    ends = np.concatenate((blanks, [len(data)]))
    many = max(1, len(starts) - words + 1)
    last = np.arange(many) + (min(words, len(starts)) - 1)
    return np.unique(Rolling(data.astype(np.uint64), _BASES[0]).of(starts[:many], ends[last]))


def survival(depth: int) -> float:
    """Chance that a pair at the threshold shares a leaf so many levels below a node."""
    found = 1.0
    for _ in range(depth):
        found = 1 - math.exp(-found)
    return found


def runs_for(recall: float, depth: int) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - survival(depth)))


def least_shared(similarity: float) -> int:
    """Of `T` tokens, how many two records share at least to become a candidate: four standard
    deviations below what the similarity gives."""
    spread = math.sqrt(T * similarity * (1 - similarity))
    return max(1, math.floor(T * similarity - 4 * spread))


def roots(recall: float, depth: int, similarity: float) -> np.ndarray:
    """The coordinates that all runs pick at their roots; each is picked once."""
    count = math.ceil(runs_for(recall, depth) / similarity)
    if count > T:
        raise ValueError(f"{count} coordinates are needed and a sketch has {T}: see T")
    return np.random.default_rng(7).permutation(T)[:count]


_FACTORS = np.random.default_rng(11).integers(1, 1 << 62, T, dtype=np.uint64) * _U(2) + _U(1)


def least_hashes(grams: np.ndarray) -> np.ndarray:
    out = np.empty(T, np.uint64)
    for k in range(0, T, 16):
        out[k : k + 16] = (grams[:, None] * _FACTORS[k : k + 16]).min(axis=0)
    return out


_SETS = pa.schema(
    [("did", pa.int64()), ("sig", pa.int64()), ("sid", pa.int64()), ("size", pa.int64()),
     ("sketch", pa.binary()), ("roots", pa.list_(pa.int64()))]
)
_SETS_COLUMNS = "did long, sig long, sid long, size long, sketch binary, roots array<long>"


def _sketch(words: int, picked: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                out = {name: [] for name in _SETS.names}
                for text in part.column("text").to_pylist():
                    grams = shingles(text, words)
                    sketch = least_hashes(grams) if len(grams) else np.zeros(T, np.uint64)
                    nodes = mixed(sketch[picked] + (picked.astype(np.uint64) << _U(40)))
                    out["sid"].append(int(mixed(grams).sum().view(np.int64)) if len(grams) else 0)
                    out["size"].append(len(grams))
                    out["sketch"].append((sketch >> _U(40)).astype("<u2").tobytes())
                    out["roots"].append(nodes.view(np.int64))
                yield batch_of(
                    _SETS, **out | {"did": part.column("did"), "sig": part.column("sig")}
                )

    return run


_NODES = "node long, sid long, size long, sketch binary"
_NODE = pa.schema(
    [("node", pa.int64()), ("sid", pa.int64()), ("size", pa.int64()), ("sketch", pa.binary())]
)


def _sketches(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("sketch").to_pylist()), "<u2").reshape(-1, T)


def _children(similarity: float):
    chance = _U(int((1 << 64) / (similarity * T)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coordinates = mixed(np.arange(1, T + 1, dtype=np.uint64) * _BASES[1])
        for batch in batches:
            node = batch.column("node").to_numpy().view(np.uint64)
            token = mixed(node[:, None] ^ coordinates)
            row, at = np.nonzero(token < chance)
            child = mixed(token[row, at] + _sketches(batch)[row, at])
            taken = batch.take(pa.array(row))
            yield batch_of(
                _NODE,
                node=child.view(np.int64),
                **{c: taken.column(c) for c in ("sid", "size", "sketch")},
            )

    return run


class Forest:
    """Disjoint sets; `join` says whether two were apart."""

    def __init__(self) -> None:
        self.above: dict[int, int] = {}

    def top(self, x: int) -> int:
        above = self.above
        while (up := above.get(x, x)) != x:
            above[x] = above.get(up, up)
            x = up
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.top(a), self.top(b)
        if a == b:
            return False
        self.above[max(a, b)] = min(a, b)
        return True


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _compare(similarity: float):
    """Candidate links inside leaves; batches come ordered by node."""
    least = least_shared(similarity)

    def links(table: pa.Table, forest: Forest) -> Iterator[pa.RecordBatch]:
        batch = table.combine_chunks().to_batches()[0]
        node, sid, size = (batch.column(c).to_numpy() for c in ("node", "sid", "size"))
        sketch = _sketches(batch)
        out: list[tuple[int, int]] = []
        at = np.arange(len(node))
        shift = 1
        while len(at):
            at = at[at + shift < len(node)]
            at = at[node[at] == node[at + shift]]
            a, b = size[at], size[at + shift]
            near = at[np.minimum(a, b) >= similarity * np.maximum(a, b)]
            for k in range(0, len(near), 20_000):
                x = near[k : k + 20_000]
                x = x[(sketch[x] == sketch[x + shift]).sum(axis=1) >= least]
                for i, j in zip(sid[x].tolist(), sid[x + shift].tolist()):
                    if forest.join(i, j):
                        out.append((i, j))
            shift += 1
        yield batch_of(_LINKS, a=[a for a, _ in out], b=[b for _, b in out])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        rest: pa.Table | None = None
        for batch in batches:
            if not len(batch):
                continue
            table = pa.Table.from_batches([batch])
            rest = table if rest is None else pa.concat_tables([rest, table])
            nodes = rest.column("node").to_numpy()
            cut = int(np.searchsorted(nodes, nodes[-1]))
            if cut:
                yield from links(rest.slice(0, cut), forest)
                rest = rest.slice(cut)
        if rest is not None:
            yield from links(rest, forest)

    return run


def _in_blocks(rows: DataFrame, group: str, count: str, block: int) -> DataFrame:
    """Deal large groups to pairs of blocks: `group` becomes (group, i, j), and `part` says in
    which of the two a row is.  A group of one block is dealt to (0, 0)."""
    blocks = F.ceil(F.col(count) / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("sid"), blocks).cast("int")
    return (
        rows.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
    )


def _candidates(sets: DataFrame, similarity: float, depth: int, leaf: int) -> DataFrame:
    """Links (a, b) that hold every pair that shares a leaf and enough tokens."""
    records = sets.where("size > 0").dropDuplicates(["sid"])
    records = stored(records.select("sid", "size", "sketch", "roots"), "records")
    nodes = records.select("sid", F.explode("roots").alias("node"))
    shared = nodes.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
    rows = nodes.join(shared, "node").join(records.drop("roots"), "sid")
    leaves: DataFrame | None = None
    for level in range(1, depth + 1):
        rows = stored(rows.select("node", "n", "sid", "size", "sketch"), f"nodes-{level}")
        small = rows.where(F.col("n") <= leaf)
        leaves = small if leaves is None else leaves.unionByName(small)
        rows = rows.where(F.col("n") > leaf)
        if level == depth or rows.isEmpty():
            break
        rows = stored(
            rows.select("node", "sid", "size", "sketch").mapInArrow(_children(similarity), _NODES),
            f"children-{level}",
        )
        shared = rows.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
        rows = rows.join(shared, "node")
    blocks = _in_blocks(rows, "node", "n", leaf).withColumn("node", F.xxhash64("node", "i", "j"))
    columns = ["node", "sid", "size", "sketch"]
    return (
        leaves.select(columns)
        .unionByName(blocks.select(columns))
        .repartition("node")
        .sortWithinPartitions("node")
        .mapInArrow(_compare(similarity), "a long, b long")
    )


def _pack_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("did", pa.int64()), ("sig", pa.int64()), ("packed", pa.binary())])
    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        yield batch_of(
            schema,
            did=batch.column("did"),
            sig=batch.column("sig"),
            packed=[press.compress(t.as_buffer()) for t in batch.column("text")],
        )


def linked(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """The matrix of sets that are similar enough, by exact counts."""
    sizes = np.array([len(s) for s in sets], np.int64)
    tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    fresh = np.concatenate(([True], tokens[1:] != tokens[:-1])) if len(tokens) else np.zeros(0, bool)
    index = np.cumsum(fresh) - 1
    common = np.bincount(index)[index] > 1 if len(index) else fresh
    owner, index = owner[common], index[common]
    index = np.cumsum(np.concatenate(([True], index[1:] != index[:-1]))) - 1 if len(index) else index
    both = np.zeros((len(sets), len(sets)), np.float32)
    columns = 4096
    for low in range(0, int(index[-1]) + 1 if len(index) else 0, columns):
        a, b = np.searchsorted(index, (low, low + columns))
        part = np.zeros((len(sets), columns), np.float32)
        part[owner[a:b], index[a:b] - low] = 1
        both += part @ part.T
    union = sizes[:, None] + sizes[None, :] - both
    found = both >= similarity * union - 1e-6
    found &= both > 0
    np.fill_diagonal(found, False)
    return found


_JUDGED = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])


def _verify(words: int, similarity: float):
    def run(key, table):
        table = table.sort_by("sid")
        sid = table.column("sid").to_numpy()
        first = np.flatnonzero(np.concatenate(([True], sid[1:] != sid[:-1])))
        table, sid = table.take(pa.array(first)), sid[first]
        copies, own = (table.column(c).to_numpy() for c in ("copies", "own"))
        press = zstandard.ZstdDecompressor()
        sets = [
            shingles(press.decompress(p).decode(), words)
            for p in table.column("packed").to_pylist()
        ]
        found = linked(sets, similarity)
        i, j = key[1].as_py(), key[2].as_py()
        if i != j:  # pairs inside a block belong to (i, i) and (j, j)
            found &= own[:, None] != own[None, :]
        links = found @ copies
        forest = Forest()
        out = [(s, s, n) for s, n in zip(sid.tolist(), links.tolist()) if n]
        for x, y in zip(*(k.tolist() for k in np.nonzero(np.triu(found)))):
            if forest.join(x, y):
                out.append((int(sid[x]), int(sid[y]), 0))
        columns = list(zip(*out)) if out else [[]] * 3
        return pa.Table.from_batches(
            [batch_of(_JUDGED, **dict(zip(_JUDGED.names, map(list, columns))))]
        )

    return run


def classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    depth: int = DEPTH,
    leaf: int = LEAF,
    block: int = BLOCK,
) -> DataFrame:
    """(did, sig, head, n_links, n_copies) for each row of `docs`; `head` is the (did, sig) of
    the least document of its class."""
    prepare(docs.sparkSession)
    rows = keyed(docs, id_col, text_col)
    picked = roots(recall, depth, similarity)
    sets = stored(rows.mapInArrow(_sketch(words, picked), _SETS_COLUMNS), "sets")
    groups = stored(
        sets.where("size > 0")
        .groupBy("sid")
        .agg(F.min(F.struct("did", "sig")).alias("first"), F.count("*").alias("copies")),
        "groups",
    )
    near = components(_candidates(sets, similarity, depth, leaf))
    near = stored(near, "near").withColumnsRenamed({"node": "sid"})
    sizes = near.groupBy("component").agg(F.count("*").alias("n"))
    members = (
        near.join(sizes, "component")
        .join(groups, "sid")
        .select("component", "n", "sid", "copies", "first.did", "first.sig")
    )
    packed = rows.mapInArrow(_pack_texts, "did long, sig long, packed binary")
    dealt = _in_blocks(members.join(packed, ["did", "sig"]), "component", "n", block)
    judged = stored(
        dealt.select("component", "i", "j", "sid", "copies", "own", "packed")
        .groupBy("component", "i", "j")
        .applyInArrow(_verify(words, similarity), "a long, b long, links long"),
        "judged",
    )
    links = (
        judged.where("a = b").groupBy(F.col("a").alias("sid")).agg(F.sum("links").alias("links"))
    )
    connected = components(judged.where("a <> b").select("a", "b"))
    connected = connected.withColumnsRenamed({"node": "sid"})
    heads = (
        connected.join(groups, "sid").groupBy("component").agg(F.min("first").alias("head"))
    )
    known = (
        groups.join(links, "sid", "left")
        .join(connected.join(heads, "component").select("sid", "head"), "sid", "left")
        .select(
            "sid",
            F.coalesce("head", "first").alias("head"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.col("copies").alias("n_copies"),
        )
    )
    return (
        sets.select("did", "sig", F.when(F.col("size") > 0, F.col("sid")).alias("sid"))
        .join(known, "sid", "left")
        .select(
            "did",
            "sig",
            F.coalesce("head", F.struct("did", "sig")).alias("head"),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
        )
    )


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, class_id, n_links, n_copies), a row for each row of `docs`.

    `class_id` is the least id of the documents that links connect; `n_links` the number of
    other documents that are similar enough, copies included; `n_copies` that of documents with
    the same shingles, itself included.
    """
    return classes(docs, **options).select(
        real_id(), real_id("head.did").alias("class_id"), "n_links", "n_copies"
    )


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """The rows of `docs` that are the least of their class; rows that repeat both id and text
    stay once."""
    heads = (
        classes(docs, id_col, text_col, **options)
        .where((F.col("did") == F.col("head.did")) & (F.col("sig") == F.col("head.sig")))
        .select("did", "sig")
        .distinct()
    )
    return (
        whole(docs, id_col, text_col)
        .join(heads, ["did", "sig"], "left_semi")
        .dropDuplicates(["did", "sig"])
        .select("row.*")
    )
