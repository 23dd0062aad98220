"""Merkle manifest of a table: a persistent tree of digests, one version for every changed leaf.

A leaf is the digest of a row. Leaves of one tree stand in key order; every ``ARITY`` consecutive nodes become
the digest of their digests (the last run may hold fewer, even one) until one node is left. The roots of the
trees, in the order of their names, are the leaves of the tree above them.

The tree is cut into aligned blocks of ``ARITY ** BLOCK_LEVELS`` nodes, each the subtree of one node. A task
builds a block once; a changed leaf makes a version of it by copying the leaf's ancestors inside the block, every
other node is shared. The copy of the block's root goes on as a row: the roots of blocks are the nodes of
the next pass, and a version meets the siblings of its block there through a join, so upper copies are spread
like the rows are. A pass turns 729 nodes into one; a thousand million rows take four passes.

A tree's rows are numbered within ranges of the key, so a tree with a third of all rows is spread like any other, and no
task holds more than a block. Tables between passes are written to the shared folder.

Defined results: NULL fields are ``-``; a NULL source is a tree of its own and the first; NULL doc_id comes first
within its source and is never changed; rows with equal doc_id are ordered by their digests, so equal rows may
change places without changing any digest. An empty table gives an empty result. Only the five fields of the
contract enter a leaf; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm import scratch

# The fields of a leaf in order, and the nodes of a run.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3
BLOCK_LEVELS = 6

STEPS = "array<struct<l: string, r: string>>"
CLIMBED = f"tree string, pos long, doc_id long, leaf string, steps {STEPS}, copies array<string>, root string"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the joined parts."""
    return F.sha2(F.concat(*parts), 256)


def leaf_of(fields: Sequence[Column]) -> Column:
    """Digest of the fields: ``-`` if NULL, else byte count, ``:`` and the value."""
    written = []
    for field in fields:
        text = field.cast("string")
        written += [F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))]
    return digest(*written)


def without_breaks(docs: DataFrame) -> tuple[Column, Column]:
    """Whether a row is changed, and its changed text: line breaks go where 2 divides the checksum of doc_id."""
    picked = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    return picked, F.translate(F.col("text"), "\n", "")


def leaves(docs: DataFrame, change: Callable[[DataFrame], tuple[Column, Column]] = without_breaks) -> DataFrame:
    """(doc_id, tree, leaf, changed): digests of the rows, and of the changed rows (NULL where nothing is changed)."""
    picked, text = change(docs)
    plain = [F.col(c) for c in FIELDS]
    altered = F.when(picked, leaf_of([*plain[:-1], text]))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("tree"), leaf_of(plain).alias("leaf"), altered.alias("changed")
    )


def placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows with ``pos`` from 0 inside their tree, in ``order``, NULL first, and ``n``, the size of the tree.

    Rows are cut into ranges of (tree, order); those of a tree are counted by range, and numbered inside one. ``order``
    tells all rows apart, so that no range has to hold a large group of equal ones.
    """
    keys = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    ranged = scratch.written(rows.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select(
        F.col("tree").alias("t"), F.col("part").alias("p"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("begin"),
        F.sum("rows").over(Window.partitionBy("tree")).alias("n"),
    )
    inside = F.row_number().over(Window.partitionBy("part", "tree").orderBy(*keys[1:])) - 1
    numbered = ranged.withColumn("inside", inside).join(begins, F.col("tree").eqNullSafe(F.col("t")) & (F.col("part") == F.col("p")))
    return numbered.withColumn("pos", F.col("begin") + F.col("inside")).drop("t", "p", "part", "begin", "inside")


def node(children: Sequence[str]) -> str:
    return sha256("".join(children).encode()).hexdigest()


def grown(nodes: Sequence[str], levels: int) -> list[list[str]]:
    """Levels of a block from its leaves to its root."""
    tree = [list(nodes)]
    for _ in range(levels):
        below = tree[-1]
        tree.append([node(below[i : i + ARITY]) for i in range(0, len(below), ARITY)])
    return tree


def steps_of(tree: Sequence[Sequence[str]], at: int) -> list[tuple[str, str]]:
    """Siblings left and right of the path from a leaf to the block's root, joined, level by level."""
    steps = []
    for level in tree[:-1]:
        first = at - at % ARITY
        steps.append(("".join(level[first:at]), "".join(level[at + 1 : first + ARITY])))
        at //= ARITY
    return steps


def copied(steps: Sequence[tuple[str, str]], leaf: str) -> list[str]:
    """The copies that a version makes: a changed leaf and its ancestors; siblings are shared."""
    path = [leaf]
    for left, right in steps:
        path.append(node((left, path[-1], right)))
    return path


def levels_of(n: int) -> int:
    """Levels above ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def block_of(pos: str = "pos") -> Column:
    """Number of the aligned block, which is the place of its root in the next pass."""
    size = ARITY**BLOCK_LEVELS
    return ((F.col(pos) - F.col(pos) % size) / size).cast("long")


def climb(nodes: DataFrame) -> DataFrame:
    """One pass over (tree, pos, n, doc_id, leaf, changed): each node's siblings up to its block's root, the copies of its
    version, and, with the first node of a block, that root."""

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["pos"])
        tree = grown([r["leaf"] for r in rows], min(BLOCK_LEVELS, levels_of(rows[0]["n"])))
        steps = [steps_of(tree, at) for at in range(len(rows))]
        copies = [copied(s, r["changed"]) if r["changed"] is not None else None for s, r in zip(steps, rows)]
        kind = pa.list_(pa.struct([("l", pa.string()), ("r", pa.string())]))
        out = {
            "tree": pa.array([r["tree"] for r in rows], pa.string()), "pos": pa.array([r["pos"] for r in rows], pa.int64()),
            "doc_id": pa.array([r["doc_id"] for r in rows], pa.int64()), "leaf": pa.array([r["leaf"] for r in rows], pa.string()),
            "steps": pa.array([[{"l": left, "r": right} for left, right in s] for s in steps], kind),
            "copies": pa.array(copies, pa.list_(pa.string())), "root": pa.array([tree[-1][0]] + [None] * (len(rows) - 1), pa.string()),
        }
        yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    rows = nodes.select("tree", "pos", "n", "doc_id", "leaf", "changed")
    return rows.groupBy("tree", block_of().alias("block")).applyInArrow(grow, CLIMBED)


def fold(steps: Column, start: Column) -> Column:
    """Digest at the upper end of a path."""
    return F.aggregate(steps, start, lambda x, s: digest(s["l"], x, s["r"]))


def copied_on(copies: Column, steps: Column) -> Column:
    """The copies of a version, then those of its further ancestors along ``steps``."""
    return F.aggregate(steps, copies, lambda path, s: F.concat(path, F.array(digest(s["l"], F.element_at(path, -1), s["r"]))))


def passes_of(nodes: DataFrame) -> list[DataFrame]:
    """Passes from the leaves up; in the last one every block is the top of a tree."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    passes = [scratch.written(climb(nodes), "climbed")]
    while most > ARITY**BLOCK_LEVELS:
        most = -(-most // ARITY**BLOCK_LEVELS)
        tops = passes[-1].where(F.col("root").isNotNull()).select("tree", block_of().alias("pos"), F.col("root").alias("leaf"))
        counts = tops.groupBy(F.col("tree").alias("t")).agg(F.count(F.lit(1)).alias("n"))
        sized = tops.join(counts, F.col("tree").eqNullSafe(F.col("t"))).withColumns({"doc_id": F.lit(None).cast("long"), "changed": F.lit(None).cast("string")})
        passes.append(scratch.written(climb(sized), "climbed"))
    return passes


def roots_of(passes: list[DataFrame]) -> DataFrame:
    return passes[-1].where(F.col("root").isNotNull()).select("tree", F.col("root").alias("subroot"))


def whole_paths(passes: list[DataFrame], ends: DataFrame | None = None) -> DataFrame:
    """Rows of the first pass with whole paths. From the top down each pass takes over the paths of the one above, so that
    only the leaves' own join is large; ``ends`` (tree, subroot, steps) goes on top of every tree."""
    rows = passes[-1].drop("root")
    if ends is not None:
        # Every tree has at most a block of rows here.
        above = ends.select(F.col("tree").alias("t"), "subroot", F.col("steps").alias("up"))
        rows = rows.join(above, F.col("tree").eqNullSafe(F.col("t"))).drop("t")
        rows = rows.withColumns({"steps": F.concat("steps", "up"), "copies": copied_on(F.col("copies"), F.col("up"))}).drop("up")
    for lower in reversed(passes[:-1]):
        carried = ["subroot"] if ends is not None else []
        above = rows.select(F.col("tree").alias("t"), F.col("pos").alias("p"), F.col("steps").alias("up"), *carried)
        rows = lower.drop("root").join(above, F.col("tree").eqNullSafe(F.col("t")) & (block_of() == F.col("p")))
        rows = rows.withColumns({"steps": F.concat("steps", "up"), "copies": copied_on(F.col("copies"), F.col("up"))}).drop("t", "p", "up")
    return rows


def manifest(docs: DataFrame, change: Callable[[DataFrame], tuple[Column, Column]] = without_breaks) -> DataFrame:
    """(doc_id, tree, pos, leaf, steps, copies, subroot, root) for each row.

    ``steps`` are the siblings of the path to ``root``. ``copies`` are the nodes that the version of a changed leaf does
    not share, from the leaf to the version's root; NULL where nothing is changed.
    """
    rows = scratch.written(leaves(docs, change).withColumn("serial", F.monotonically_increasing_id()), "leaves")
    passes = passes_of(scratch.written(placed(rows, ("doc_id", "leaf", "changed", "serial")), "placed"))
    # The roots are the leaves of one more tree, in the order of their names.
    named = roots_of(passes).select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("subroot").alias("leaf"))
    named = placed(named, ("name",)).withColumns({"doc_id": F.lit(None).cast("long"), "changed": F.lit(None).cast("string")})
    named = scratch.written(named, "named")
    upper = passes_of(named)
    names = named.select(F.col("pos").alias("p"), F.col("name").alias("tree"), F.col("leaf").alias("subroot"))
    ends = whole_paths(upper).join(names, F.col("pos") == F.col("p")).select(names["tree"], "subroot", "steps")
    top = roots_of(upper).first()
    return whole_paths(passes, ends).withColumn("root", F.lit(top["subroot"] if top else None).cast("string"))


def proofs(rows: DataFrame) -> DataFrame:
    """The digest columns: the proof, the root folded from the changed leaf (else the leaf), and whether it is the root."""
    siblings = F.aggregate("steps", F.lit(""), lambda x, s: F.concat(x, s["l"], s["r"]))
    folded = F.coalesce(F.element_at("copies", -1), fold(F.col("steps"), F.col("leaf")))
    out = rows.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
