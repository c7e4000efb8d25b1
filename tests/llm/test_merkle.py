import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ratebook.llm import merkle
from ratebook.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
#: Extra columns are named as the operator names its own.
COLUMNS = (
    "doc_id long, source string, lang string, n_chars long, text string, "
    "tree int, node string, place string, part int, size int, path int"
)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "n", "p", 2, 3, 4) for r in rows], COLUMNS).repartition(5)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    def field(value):
        if value is None:
            return "-"
        text = str(value)
        return f"{len(text.encode())}:{text}"

    return sha("".join(map(field, row)))


def proofs_of(leaves):
    """A tree's root, and each leaf's path as (before, after) from the bottom up."""
    paths = [[] for _ in leaves]
    level, height = list(leaves), 0
    while len(level) > 1:
        for i, path in enumerate(paths):
            at = i // 3**height
            first = at // 3 * 3
            path.append(("".join(level[first:at]), "".join(level[at + 1 : first + 3])))
        level = [sha("".join(level[k : k + 3])) for k in range(0, len(level), 3)]
        height += 1
    return level[0], paths


def expected(rows):
    parts = defaultdict(list)
    for row in rows:
        parts[row[1]].append(row)
    names = sorted(parts, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        ordered = sorted(parts[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[name] = (ordered, *proofs_of([leaf(r) for r in ordered]))
    root, upper = proofs_of([trees[n][1] for n in names])
    out = []
    for name, above in zip(names, upper):
        ordered, subroot, paths = trees[name]
        for row, path in zip(ordered, paths):
            whole = path + above
            seen = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                seen = (*row[:4], row[4].replace("\n", ""))
            node = leaf(seen)
            for before, after in whole:
                node = sha(before + node + after)
            proof = sha("".join(b + a for b, a in whole))
            out.append((row[0], leaf(row), subroot, root, proof, node, node == root))
    return Counter(out)


def found(frame):
    assert frame.columns == [
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    ]
    return Counter(map(tuple, frame.collect()))


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.select("doc_id", "source", "lang", "n_chars", "text").collect()
    got = found(QUERIES["op11_merkle_manifest"](spark, SF))
    assert got == expected([tuple(r) for r in rows])
    assert {r[-1] for r in got} == {True, False}


def test_trees_of_every_height(spark):
    """A part of one row, and parts around each power of the arity; one part is most rows."""
    rows = []
    for name, n in zip("abcdefghij", (1, 2, 3, 4, 9, 10, 27, 28, 82, 740)):
        rows += [(1000 * len(rows) + i, name, "en", 7, f"{name}\n{i}") for i in range(n)]
    assert found(merkle.digests(table(spark, rows))) == expected(rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (1, "a", None, None, None),
        (1, "a", "", 0, ""),
        (1, "a", "", 0, ""),
        (None, "a", "en", 3, "x\ny"),
        (None, "a", "en", 3, "x\nz"),
        (2, None, "en", 3, "\n\n"),
        (3, None, "en", 3, "\n\n"),
        (4, "", "en", 3, "é\n東"),
        (5, "é", "en", 2**40, "x" * 200_000 + "\n"),
        (-6, "z", "en", -1, "-"),
    ]
    assert found(merkle.digests(table(spark, rows))) == expected(rows)


@pytest.mark.parametrize("rows", [[], [(7, None, None, None, None)]])
def test_small_tables(spark, rows):
    got = found(merkle.digests(table(spark, rows)))
    assert got == (expected(rows) if rows else Counter())


def test_many_parts(spark):
    """More parts than one subtree of the top tree holds."""
    rows = [(i, f"host{i % 90:02}", "en", 1, f"t\n{i}") for i in range(300)]
    assert found(merkle.digests(table(spark, rows))) == expected(rows)


def test_only_every_third_level_is_kept(spark, tmp_path):
    rows = [(i, "s", "en", 1, str(i)) for i in range(800)]
    held = merkle.manifest(table(spark, rows), path=str(tmp_path / "m"))
    kept = [level.select(F.size("members").alias("n")).collect() for level in held.trees.levels]
    assert [sum(r.n for r in level) for level in kept] == [800, 30, 2]
    again = merkle.opened(spark, str(tmp_path / "m"))
    assert again.root() == held.root() is not None
    first, second = (
        {(r.leaf, str(r.path)) for r in m.proofs().collect()} for m in (held, again)
    )
    assert first == second and len(first) == 800


def test_reserved_names_are_refused(spark):
    with pytest.raises(ValueError):
        merkle.manifest(table(spark, []), beside={"node": F.lit(1)})
