"""Merkle manifest of a dataset: trees of eight, and proofs that are looked up by coordinates.

A row's leaf is the SHA-256 of its fields. Each group (lang) is a tree: its leaves in order of the
id, every eight nodes hashed into one of the next level until one remains, the subroot; the subroots
in order of the group are the leaves of a tree on top, whose last node is the root. All nodes are one
materialised table (tree, level, idx, hash).

A proof is looked up, not walked: from a leaf's index and its tree's size alone follow the
coordinates of the siblings it needs; they are exploded, joined with the node table, put in order and
folded. Siblings high up are the same for many leaves. So from the level on where the whole dataset
has at most SHARED nodes, they are asked for once for each node of that level and joined with its
leaves by broadcast (if a count shows that there are few; many small trees are joined by shuffle);
below it a node is asked for by at most 7 x 8^level leaves, so no key of the shuffled join is hot.

Leaves are numbered by ranges with prefix sums, so a group with most of the rows is dealt to many tasks.

Defined cases: a null field is '-', an empty one '0:'; a null group is a tree of its own, the first;
rows of one id are leaves in order of their hashes, repeated rows as often as they stand there; a lone
leaf is its subroot, a lone subroot the root, with an empty proof (the hash of the empty string); an
empty table gives no rows; columns other than those named are ignored, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import numbered
from .common import Scratch

ARITY, SHARED = 8, 1 << 12
TOP = -1  # the number of the tree over the subroots
TOP_ORDER = 64  # its levels come after all levels of the trees below
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, UPPER.lower())


def field(c: Column) -> Column:
    """'-' for null, else the number of UTF-8 bytes, a colon and the value."""
    value = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_hash(fields: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, fields)), 256))


def _hex(c: Column) -> Column:
    return F.lower(F.hex(c))


SIBLING = "struct<tree:bigint,level:int,idx:bigint,at:int>"


def _coordinates(tree: str, idx: str, size: str, levels: range, base: int = 0, order: int = 0) -> Column:
    """array<SIBLING>: what a node of level base needs at these levels of its tree; at is the place of a level in the proof."""

    def of_level(level: int) -> Column:
        pos = F.expr(f"{idx} div {ARITY ** (level - base)}L")
        n = F.expr(f"({size} + {ARITY**level - 1}L) div {ARITY**level}L")
        first = F.expr(f"{idx} div {ARITY ** (level - base + 1)}L * {ARITY}L")
        run = F.sequence(first, F.least(first + (ARITY - 1), n - 1))
        others = F.transform(F.filter(run, lambda i: i != pos), lambda i: F.struct(F.expr(tree).cast("long").alias("tree"), F.lit(level).alias("level"), i.alias("idx"), F.lit(order + level).alias("at")))
        return F.when(n > 1, others).otherwise(F.array().cast(f"array<{SIBLING}>"))

    return F.concat(F.array().cast(f"array<{SIBLING}>"), *map(of_level, levels))


def _levels(size: int) -> int:
    """Levels above the leaves in a tree of so many."""
    n = 0
    while size > 1:
        size, n = -(-size // ARITY), n + 1
    return n


class Manifest:
    """The numbered leaves, the node table and the root of a dataset.

    leaves: id, leaf, changed (the leaf of the tampered row or null), tree, idx, size, trees (their number).
    nodes: tree, level, idx, size (nodes of that level), hash.
    """

    def __init__(self, rows: DataFrame) -> None:
        """rows: id long, lang string, leaf binary, changed binary."""
        self.scratch = keep = Scratch(rows.sparkSession)
        rows = keep.keep(rows, "hashed")  # ordering by ranges reads its input twice
        placed = numbered(rows.select("id", "lang", "leaf", "changed"), ["id", "leaf"], ["lang"], "idx", 0)
        sizes = numbered(placed.groupBy("lang").agg(F.count("*").alias("size")), ["lang"], name="tree", start=0)
        self.trees = keep.keep(sizes, "trees")
        most, n_trees = self.trees.agg(F.max("size"), F.count("*")).first()
        self.most, self.n_trees, self.total = most or 0, n_trees, self.trees.agg(F.sum("size")).first()[0] or 0
        named = self.trees.withColumnRenamed("lang", "_lang")
        self.leaves = keep.keep(placed.join(named, F.col("lang").eqNullSafe(F.col("_lang"))).select("id", "leaf", "changed", "tree", "idx", "size"), "leaves")
        below = self._grown(self.leaves.select("tree", "idx", "size", F.col("leaf").alias("hash")), _levels(self.most))
        self.subroots = keep.keep(reduce(DataFrame.unionByName, below).where("size = 1").select("tree", F.col("hash").alias("subroot")), "subroots")
        top = self.subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(self.n_trees).cast("long").alias("size"), F.col("subroot").alias("hash"))
        above = self._grown(top, _levels(self.n_trees))
        self.root = above[-1].where("size = 1").select(_hex(F.col("hash")))
        self.nodes = reduce(DataFrame.unionByName, (df.withColumn("level", F.lit(level)) for tier in (below, above) for level, df in enumerate(tier)))

    def _grown(self, nodes: DataFrame, levels: int) -> list[DataFrame]:
        """All levels of nodes (tree, idx, size, hash), from the given one up."""
        out = [nodes]
        for level in range(1, levels + 1):
            run = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "hash"))), lambda n: _hex(n["hash"])), "")
            above = out[-1].where("size > 1").groupBy("tree", F.expr(f"idx div {ARITY}L").alias("idx"))
            out.append(self.scratch.keep(above.agg(F.expr(f"(first(size) + {ARITY - 1}L) div {ARITY}L").alias("size"), F.unhex(F.sha2(run, 256)).alias("hash")), f"level{level}"))
        return out

    def _found(self, rows: DataFrame, key: list[str], asked: Column, nodes: DataFrame) -> DataFrame:
        """(key, siblings): array<struct(at, idx, hash)> from the lowest level up, left to right, for each row that needs any; by merging at any size."""
        asks = rows.select(*(F.col(k).alias(f"of_{k}") for k in key), F.explode(asked).alias("c")).select(*(f"of_{k}" for k in key), "c.*")
        met = asks.join(nodes.where("size > 1").select("tree", "level", "idx", "hash").hint("merge"), ["tree", "level", "idx"])
        found = met.groupBy(*(f"of_{k}" for k in key)).agg(F.array_sort(F.collect_list(F.struct("at", "idx", "hash"))).alias("siblings"))
        return found.select(*(F.col(f"of_{k}").alias(k) for k in key), "siblings")

    def proofs(self) -> DataFrame:
        """tree, idx, size, id, leaf, changed, siblings: the leaves with the siblings that they need, from the lowest level up, left to right."""
        cut, levels, top = _levels(-(-self.total // SHARED)), _levels(self.most), _levels(self.n_trees)
        low = self._found(self.leaves, ["tree", "idx"], _coordinates("tree", "idx", "size", range(min(cut, levels))), self.nodes.where(F.col("level") < cut))
        base = f"div {ARITY**cut}L"
        bases = self.trees.select("tree", "size", F.lit(self.n_trees).cast("long").alias("trees"), F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(size - 1) {base}"))).alias("base"))
        asked = F.concat(_coordinates("tree", "base", "size", range(cut, levels), cut), _coordinates(str(TOP), "tree", "trees", range(top), 0, TOP_ORDER))
        high = self._found(bases, ["tree", "base"], asked, self.nodes.where((F.col("level") >= cut) | (F.col("tree") == TOP))).withColumnRenamed("siblings", "above")
        if self.total // ARITY**cut + self.n_trees <= 4 * SHARED:  # no fewer than the rows of high
            high = F.broadcast(high)
        none = F.array().cast("array<struct<at:int,idx:bigint,hash:binary>>")
        rows = self.leaves.join(low.hint("merge"), ["tree", "idx"], "left").withColumn("base", F.expr(f"idx {base}")).join(high, ["tree", "base"], "left")
        return rows.withColumn("siblings", F.concat(F.coalesce("siblings", none), F.coalesce("above", none))).drop("above", "base")


def _steps(idx: str, size: str, levels: int, order: int) -> Column:
    """array<struct(at, pos)>: the levels of a proof and the own index there; a run of one node is hashed too, though it brings no sibling."""
    steps = F.array(*(F.struct(F.lit(order + k).alias("at"), F.expr(f"{idx} div {ARITY**k}L").alias("pos"), F.lit(ARITY**k).cast("long").alias("width")) for k in range(levels)))
    return F.filter(steps.cast("array<struct<at:int,pos:bigint,width:bigint>>"), lambda s: F.expr(size) > s["width"])


def folded(leaf: Column, siblings: Column, steps: Column) -> Column:
    """The root that a leaf and its ordered siblings give level by level, in hex."""

    def step(acc: Column, at: Column) -> Column:
        side = lambda left: F.array_join(F.transform(F.filter(siblings, lambda s: (s["at"] == at["at"]) & ((s["idx"] < at["pos"]) if left else (s["idx"] > at["pos"]))), lambda s: _hex(s["hash"])), "")
        return F.sha2(F.concat(side(True), acc, side(False)), 256)

    return F.aggregate(steps, leaf, step)


def manifest_rows(docs: DataFrame) -> DataFrame:
    """(id, lang, leaf, changed) of documents; every third by checksum of its id is tampered: its text in lower case."""
    source = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("lang").cast("string"), F.col("n_chars").cast("long"), F.col("text").cast("string"))
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    fields = [F.col(c) for c in FIELDS]
    changed = F.when(tampered, leaf_hash([*fields[:-1], lower_ascii(F.col("text"))]))
    return source.select(F.col("doc_id").alias("id"), "lang", leaf_hash(fields).alias("leaf"), changed.alias("changed"))


def prove(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: one row a document, hashes in lower-case hex."""
    m = Manifest(manifest_rows(docs))
    root = m.root.first()
    rows = m.proofs().join(m.subroots, "tree")
    steps = F.concat(_steps("idx", "size", _levels(m.most), 0), _steps("tree", f"{m.n_trees}L", _levels(m.n_trees), TOP_ORDER))
    out = rows.select(
        F.col("id").alias("doc_id"), _hex(F.col("leaf")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"), F.lit(root[0] if root else None).alias("root"),
        F.sha2(F.array_join(F.transform("siblings", lambda s: _hex(s["hash"])), ""), 256).alias("proof_sha256"), folded(_hex(F.coalesce("changed", "leaf")), F.col("siblings"), steps).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
