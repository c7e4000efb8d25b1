"""A Merkle manifest of a dataset, of which only every few levels are kept.

Each row is a leaf; the leaves of one part (a source, say) make a tree, and the trees' roots
make the tree above them.  Three consecutive nodes become one, until one is left.

Of every tree the manifest keeps the leaves and then each third level: 27 consecutive nodes are
a kept row, an aligned subtree, and the node that they come to is a member of a row three levels
up.  The two levels between are never stored.  Proof extraction goes from the top down: a
subtree's missing nodes are worked out again from its stored members, each member's siblings are
emitted in front of those of the subtree's own root, and the nodes are gone with the row.

Leaves are numbered without a window over a part: rows are range-partitioned and written in
order, and a leaf's place is its place in its partition, plus the rows of that part in the
partitions before, a few numbers a partition.  A part that holds a third of all rows is spread
over partitions, its subtrees over keys.  Everything is DataFrame functions; nothing but the
number of levels comes to the driver.

Defined cases: a null field has a text of its own, so it differs from an empty one; a null part
is a part, and the first one; null ids come first within a part; rows of the same id are ordered
by their leaves, equal rows are leaves of their own.  An empty table has a manifest without
roots and proofs.  A table without one of the fields is an error; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratebook.llm.common import stored
from ratebook.scratch import new_folder

ARITY = 3
#: Levels from one kept level to the next, and the nodes of a subtree that high.
STEP = 3
SUBTREE = ARITY**STEP
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_PATH = "array<struct<before: string, after: string>>"


def sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def encoded(value: Column) -> Column:
    """A field's text, which tells where it ends: `-`, or its length in bytes and its value."""
    text = value.cast("string")
    sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(sized, F.lit("-"))


def leaf_of(*fields: Column) -> Column:
    return sha(F.concat(*map(encoded, fields)))


# --- trees ------------------------------------------------------------------


def numbered(rows: DataFrame, within: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with their `place` (from 0) in the order of `order` among those that agree on
    `within`, nulls first; and the number of rows (`size`) of each value of `within`."""
    in_order = [F.col(c).asc_nulls_first() for c in (*within, *order)]
    written = stored(
        rows.repartitionByRange(*in_order)
        .sortWithinPartitions(*in_order)
        .withColumn("at", F.monotonically_increasing_id()),
        "in-order",
    ).withColumn("task", F.shiftright("at", 33))
    here = written.groupBy(*within, "task").agg(
        F.min("at").alias("first"), F.count(F.lit(1)).alias("here")
    )
    earlier = Window.partitionBy(*within).orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = here.select(
        *[F.col(c).alias(f"of_{c}") for c in within],
        F.col("task").alias("of_task"),
        (F.coalesce(F.sum("here").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
    )
    same = F.col("task") == F.col("of_task")
    for c in within:
        same &= F.col(c).eqNullSafe(F.col(f"of_{c}"))
    placed = written.join(starts, same).withColumn("place", F.col("at") + F.col("shift"))
    sizes = here.groupBy(*within).agg(F.sum("here").alias("size"))
    return placed.drop("at", "task", *starts.columns), sizes


def _steps() -> Column:
    """Levels that a subtree of a tree of `size` nodes has: fewer only at the top."""
    out = F.lit(STEP)
    for k in reversed(range(STEP)):
        out = F.when(F.col("size") <= ARITY**k, k).otherwise(out)
    return out


def _parents(nodes: str) -> Column:
    """The nodes one level up; the last run may be shorter."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / ARITY).cast("int"))
    return F.transform(
        runs, lambda r: sha(F.array_join(F.slice(nodes, r * ARITY + 1, F.lit(ARITY)), ""))
    )


def _regenerated(level: DataFrame) -> DataFrame:
    """A kept level with the levels inside its subtrees: level_0 (the members) to level_3."""
    out = level.withColumn("steps", _steps()).withColumn("level_0", F.col("members.node"))
    for k in range(STEP):
        out = out.withColumn(f"level_{k + 1}", _parents(f"level_{k}"))
    return out


def _subtrees(nodes: DataFrame) -> DataFrame:
    """Nodes (tree, size, place, node, ...) as rows of aligned subtrees.

    Rows of a subtree mostly lie in one task, so lists are shuffled rather than nodes.
    """
    carried = [c for c in nodes.columns if c not in ("tree", "size", "place")]
    return nodes.groupBy("tree", F.floor(F.col("place") / SUBTREE).alias("run")).agg(
        F.max("size").alias("size"),
        F.sort_array(F.collect_list(F.struct("place", *carried))).alias("members"),
    )


@dataclass
class Forest:
    """Trees; `levels` holds the kept levels, leaves first, as (tree, run, size, members)."""

    levels: list[DataFrame]

    def tops(self, k: int) -> DataFrame:
        """What the subtrees of a kept level come to."""
        level = _regenerated(self.levels[k])
        top = F.element_at(F.array(*(F.col(f"level_{j}")[0] for j in range(STEP + 1))),
                           F.col("steps") + 1)
        return level.select("tree", "run", "size", top.alias("node"))

    def roots(self) -> DataFrame:
        """(tree, node): trees end at the level where one subtree holds them."""
        ended = [
            self.tops(k).where(F.col("size") <= SUBTREE).select("tree", "node")
            for k in range(len(self.levels))
        ]
        out = ended[0]
        for more in ended[1:]:
            out = out.unionByName(more)
        return out

    def paths(self, above: DataFrame) -> DataFrame:
        """One row a leaf: tree, its own columns, and its path: what stands before and after
        the node on each level, from the leaf's own to the root of `above` (tree, path)."""
        ended = above.select("tree", F.lit(0).cast("long").alias("run"), F.lit(True).alias("last"),
                             F.col("path").alias("rest"))
        rest = ended
        members = None
        for k in reversed(range(len(self.levels))):
            level = _regenerated(self.levels[k]).withColumn("last", F.col("size") <= SUBTREE)
            # Spark judges the paths by the files they come from, a small part of their size.
            inside = level.join(rest.hint("merge"), ["tree", "run", "last"]).select(
                "tree", "steps", "rest", *(f"level_{j}" for j in range(STEP)),
                F.posexplode("members").alias("at", "member"),
            )
            own = F.slice(F.array(*map(_siblings, range(STEP))), F.lit(1), F.col("steps"))
            members = inside.select("tree", "member", F.concat(own, F.col("rest")).alias("path"))
            rest = members.select(
                "tree", F.col("member.place").alias("run"), F.lit(False).alias("last"),
                F.col("path").alias("rest"),
            ).unionByName(ended)
        return members.select("tree", "member.*", "path")


def _siblings(k: int) -> Column:
    """What stands before and after the member's ancestor, k levels up, in its run."""
    place = F.floor(F.col("at") / ARITY**k).cast("int")
    first = F.floor(place / ARITY).cast("int") * ARITY
    before = F.slice(f"level_{k}", first + 1, place - first)
    after = F.slice(f"level_{k}", place + 2, first + ARITY - 1 - place)
    return F.struct(
        F.array_join(before, "").alias("before"), F.array_join(after, "").alias("after")
    )


def _kept(nodes: DataFrame, path: str, most: int) -> Forest:
    """Trees over nodes (tree, size, place, node, ...), written level by level."""
    forest = Forest([])
    for k in range(_levels(most)):
        if k:
            nodes = forest.tops(k - 1).where(F.col("size") > SUBTREE).select(
                "tree",
                F.ceil(F.col("size") / SUBTREE).alias("size"),
                F.col("run").alias("place"),
                "node",
            )
        subtrees = _subtrees(nodes)
        subtrees.write.parquet(f"{path}-{k}")
        forest.levels.append(
            subtrees.sparkSession.read.schema(subtrees.schema).parquet(f"{path}-{k}")
        )
    return forest


def _levels(most: int) -> int:
    """Kept levels of a tree of that many leaves."""
    levels = 1
    while most > SUBTREE:
        most = -(-most // SUBTREE)
        levels += 1
    return levels


# --- the manifest -----------------------------------------------------------


@dataclass
class Manifest:
    """`parts`: (part, tree, size); `trees`: one tree a part; `top`: the tree of their roots."""

    parts: DataFrame
    trees: Forest
    top: Forest

    def subroots(self) -> DataFrame:
        """(part, size, node) of every part."""
        return self.parts.join(self.trees.roots(), "tree").select("part", "size", "node")

    def root(self) -> str | None:
        top = self.top.roots().first()
        return top["node"] if top else None

    def proofs(self) -> DataFrame:
        """One row a leaf: part, place, leaf, the columns carried beside it, subroot and path."""
        spark = self.parts.sparkSession
        nothing = spark.range(1).select(
            F.col("id").alias("tree"), F.array().cast(_PATH).alias("path")
        )
        upper = self.top.paths(nothing).select(
            F.col("place").alias("tree"), F.col("node").alias("subroot"), "path"
        )
        leaves = self.trees.paths(upper.select("tree", "path"))
        names = self.parts.select("tree", "part").join(upper.select("tree", "subroot"), "tree")
        return leaves.join(names, "tree").drop("tree").withColumnRenamed("node", "leaf")


def manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    part: str = "source",
    order: str = "doc_id",
    beside: dict[str, Column] | None = None,
    path: str | None = None,
) -> Manifest:
    """Write the manifest of `docs` below `path` (a new shared folder, if none is named).

    `beside` names columns of `docs` that proofs carry along.
    """
    taken = {"part", "id", "node", "leaf", "place", "tree", "size", "path", "subroot"}
    if taken & set(beside or {}):
        raise ValueError(f"columns of the manifest: {sorted(taken & set(beside))}")
    spark = docs.sparkSession
    path = path or new_folder(spark, "manifest")
    leaves = stored(
        docs.select(
            F.col(f"`{part}`").alias("part"),
            F.col(f"`{order}`").alias("id"),
            leaf_of(*(F.col(f"`{f}`") for f in fields)).alias("node"),
            *[c.alias(n) for n, c in (beside or {}).items()],
        ),
        "leaves",
    )
    placed, sizes = numbered(leaves, ["part"], ["id", "node"])
    parts, _ = numbered(sizes, [], ["part"])
    parts.withColumnRenamed("place", "tree").write.parquet(f"{path}/parts")
    parts = spark.read.parquet(f"{path}/parts")
    most, trees = parts.agg(F.max("size"), F.count(F.lit(1))).first()
    named = parts.select(F.col("part").alias("of_part"), "tree", "size")
    in_trees = placed.join(named, F.col("part").eqNullSafe(F.col("of_part")))
    documents = _kept(in_trees.drop("part", "of_part"), f"{path}/documents", most or 0)
    subroots = documents.roots().select(
        F.lit(0).cast("long").alias("tree"),
        F.lit(trees).cast("long").alias("size"),
        F.col("tree").alias("place"),
        "node",
    )
    return Manifest(parts, documents, _kept(subroots, f"{path}/parts-tree", trees))


def opened(spark: SparkSession, path: str) -> Manifest:
    """A manifest that was written before."""
    parts = spark.read.parquet(f"{path}/parts")
    most, trees = parts.agg(F.max("size"), F.count(F.lit(1))).first()

    def forest(name: str, size: int) -> Forest:
        return Forest([spark.read.parquet(f"{path}/{name}-{k}") for k in range(_levels(size))])

    return Manifest(parts, forest("documents", most or 0), forest("parts-tree", trees))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path come to."""
    return F.aggregate(
        path, leaf, lambda node, s: sha(F.concat(s["before"], node, s["after"]))
    )


def siblings(path: Column) -> Column:
    """All siblings of a path, one after the other."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


# --- the registered query ---------------------------------------------------


def digests(docs: DataFrame) -> DataFrame:
    """Every document's proof, held against a copy some of whose rows lost their line ends."""
    altered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    fields = {f: F.col(f) for f in FIELDS}
    tampered = fields | {"text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))}
    changed = altered & F.col("text").contains("\n")
    held = manifest(
        docs,
        beside={"doc_id": F.col("doc_id"),
                "seen": F.when(changed, leaf_of(*tampered.values()))},
    )
    root = F.lit(held.root()).cast("string")
    seen = F.coalesce("seen", "leaf")
    return (
        held.proofs()
        .select(
            "doc_id",
            "leaf",
            "subroot",
            root.alias("root"),
            sha(siblings(F.col("path"))).alias("proof_sha256"),
            folded(seen, F.col("path")).alias("folded_root"),
        )
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )


#: The same on DuckDB.  Trees are lists there; crc32 is worked out bit by bit.
SQL = """
WITH RECURSIVE leaves AS (
  SELECT doc_id, source,
    sha256(concat(
      coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-'),
      coalesce(strlen(source) || ':' || source, '-'),
      coalesce(strlen(lang) || ':' || lang, '-'),
      coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-'),
      coalesce(strlen(text) || ':' || text, '-'))) AS leaf,
    sha256(concat(
      coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-'),
      coalesce(strlen(source) || ':' || source, '-'),
      coalesce(strlen(lang) || ':' || lang, '-'),
      coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-'),
      coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')
    )) AS altered,
    coalesce(xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT,
        list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
      lambda crc, byte: list_reduce(
        [xor(crc, byte), 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT,
         0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT],
        lambda bits, _: CASE WHEN bits & 1 = 1 THEN xor(bits >> 1, 3988292384) ELSE bits >> 1 END)
    )) % 2 = 0, false) AS tampers
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
  FROM leaves),
trees(source, k, nodes) AS (
  SELECT source, 0, list(leaf ORDER BY place) FROM placed GROUP BY source
  UNION ALL
  SELECT source, k + 1, list_transform(range(0, len(nodes), 3),
    lambda i: sha256(array_to_string(nodes[i + 1:i + 3], ''))) FROM trees WHERE len(nodes) > 1),
subroots AS (
  SELECT source, nodes[1] AS subroot,
    row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place
  FROM trees WHERE len(nodes) = 1),
top(k, nodes) AS (
  SELECT 0, list(subroot ORDER BY place) FROM subroots
  UNION ALL
  SELECT k + 1, list_transform(range(0, len(nodes), 3),
    lambda i: sha256(array_to_string(nodes[i + 1:i + 3], ''))) FROM top WHERE len(nodes) > 1),
root AS (SELECT nodes[1] AS root FROM top WHERE len(nodes) = 1),
steps AS (
  SELECT p.doc_id, p.source, p.place, t.k AS step, t.nodes,
    CAST(p.place // CAST(pow(3, t.k) AS BIGINT) AS BIGINT) AS own
  FROM placed p JOIN trees t ON t.source IS NOT DISTINCT FROM p.source AND len(t.nodes) > 1
  UNION ALL
  SELECT p.doc_id, p.source, p.place, 1000 + t.k, t.nodes,
    CAST(s.place // CAST(pow(3, t.k) AS BIGINT) AS BIGINT)
  FROM placed p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source
  JOIN top t ON len(t.nodes) > 1),
paths AS (
  SELECT source, place, list(array_to_string(nodes[own // 3 * 3 + 1:own], '') || '|' ||
    array_to_string(nodes[own + 2:own // 3 * 3 + 3], '') ORDER BY step) AS path
  FROM steps GROUP BY source, place),
folds AS (
  SELECT p.doc_id, p.leaf, s.subroot, root.root, coalesce(q.path, []) AS path,
    list_reduce(
      list_prepend(CASE WHEN p.tampers THEN p.altered ELSE p.leaf END, coalesce(q.path, [])),
      lambda node, step: sha256(split_part(step, '|', 1) || node || split_part(step, '|', 2))
    ) AS folded_root
  FROM placed p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source CROSS JOIN root
  LEFT JOIN paths q ON q.source IS NOT DISTINCT FROM p.source AND q.place = p.place)
SELECT doc_id, leaf, subroot, root,
  sha256(replace(array_to_string(path, ''), '|', '')) AS proof_sha256,
  folded_root, folded_root = root AS verified
FROM folds"""
