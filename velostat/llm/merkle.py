"""Merkle manifest of a dataset by time-forward processing.

Every row is a leaf; the leaves of one ``lang``, in the order of doc_id, make a tree, and the
trees' roots, in the order of lang, make the tree above.  Where several nodes remain,
every two consecutive ones (the last may be alone) become the SHA-256 of their digests as
hex text.

Nodes are labelled by (tree, level, place).  A forward sweep goes through them in the
order of their labels: a node takes its children's digests from a priority queue, where they
wait under its label, and puts its own digest under the label of its parent.  The queue is
external: what is to wait for a later round is a table of messages that Spark's shuffle
sorts by label, and a round takes the messages of ``LEVELS`` levels out of it, ``2 ** LEVELS``
consecutive nodes (a bundle) in a heap of a task at a time.  So no tree is gathered anywhere: the
rounds grow with log(n) / ``LEVELS``.

The reversed sweep goes through the same labels backwards: a node gets the proof from its
parent to the root as a message and sends it, with the sibling in front, to each of its
children.  One message per bundle crosses the shuffle; the leaves' proofs are folded where they arrive.

Defined results: NULL lang is a tree of its own, first; NULL doc_id comes first in its tree; rows with
the same doc_id are ordered by their digest; equal rows are leaves of their own; texts of any
length are hashed by Spark; an empty table gives an empty one; only the five columns of a
leaf are read, whatever else there is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velostat.llm.common import spark_schema, stage

LEVELS = 10  # levels of one round: bundles of 1,024 nodes
TOP = "*"  # the tree of the trees' roots

_NODES = pa.schema([("tree", pa.string()), ("place", pa.int64()), ("total", pa.int64()), ("digest", pa.string())])
_PATHS = pa.schema([("tree", pa.string()), ("place", pa.int64()), ("path", pa.string()), ("root", pa.string())])
_PROOFS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("leaf", pa.string()),
        ("subroot", pa.string()),
        ("root", pa.string()),
        ("proof_sha256", pa.string()),
        ("folded_root", pa.string()),
        ("verified", pa.bool_()),
    ]
)


def digest_of(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(n_chars: Column) -> Column:
    """Digest of a row of documents, with this column in place of n_chars."""
    return F.sha2(F.concat(*[_field(c) for c in (F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))]), 256)


def tree_name(lang: Column) -> Column:
    """Names that sort as the languages do, NULL first."""
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit(""))


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``place`` (0-based, in this order) and ``total`` within their tree.

    Rows are range-partitioned and sorted; a place is the rows of the tree in earlier
    partitions plus those before it in its own, all from one stored copy."""
    dealt = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    held = stage(dealt.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")), "merkle-order")
    cells = held.groupBy("tree", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("tree", "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(tree).alias("total"))
    placed = held.join(cells, ["tree", "_part"])
    return placed.withColumn("place", F.col("_before") + F.col("_at") - F.col("_first")).drop("_part", "_at", "_before", "_first")


def _levels_of(total: int) -> int:
    """Levels that a bundle of a tree with ``total`` nodes goes up in one round."""
    return LEVELS if total > 1 << LEVELS else max(0, total - 1).bit_length()


def forward(digests: list[str], levels: int) -> Iterator[tuple[int, int, str]]:
    """(level, place, digest) of every node above a bundle's nodes, in the order of the labels."""
    queue = [(0, place, d) for place, d in enumerate(digests)]
    heapify(queue)
    while queue[0][0] < levels:
        level, place, first = heappop(queue)
        children = [first]
        if not place % 2 and queue and queue[0][:2] == (level, place + 1):
            children.append(heappop(queue)[2])
        node = (level + 1, place // 2, digest_of(*children))
        heappush(queue, node)
        yield node


def backward(digests: list[str], levels: int, path: str) -> Iterator[tuple[int, str]]:
    """(place, path) of a bundle's nodes, the last first; ``path`` leads on from the bundle's root.

    A path has a step per level: L or R and the sibling's digest, or a dash where there is none."""
    nodes = {(0, place): d for place, d in enumerate(digests)}
    nodes.update(((level, place), d) for level, place, d in forward(digests, levels))
    queue = [(-levels, 0, path)]
    while queue:
        level, place, path = heappop(queue)
        level, place = -level, -place
        if not level:
            yield place, path
            continue
        left, right = 2 * place, 2 * place + 1
        if (level - 1, right) in nodes:
            heappush(queue, (1 - level, -right, "L" + nodes[level - 1, left] + path))
            heappush(queue, (1 - level, -left, "R" + nodes[level - 1, right] + path))
        else:
            heappush(queue, (1 - level, -left, "-" + path))


def steps(path: str) -> Iterator[tuple[str, str]]:
    at = 0
    while at < len(path):
        side, width = path[at], 0 if path[at] == "-" else 64
        yield side, path[at + 1 : at + 1 + width]
        at += 1 + width


def fold(leaf: str, path: str) -> str:
    """The root that a leaf and the siblings on its path give."""
    for side, sibling in steps(path):
        leaf = digest_of(sibling, leaf) if side == "L" else digest_of(leaf, sibling)
    return leaf


def _bundles(batches, columns: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """((tree, bundle), its rows) of sorted batches, one bundle at a time."""
    now, rows = None, []
    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in ["tree", "bundle", *columns]]):
            if row[:2] != now:
                if rows:
                    yield now, rows
                now, rows = row[:2], []
            rows.append(row[2:])
    if rows:
        yield now, rows


def _dealt(rows: DataFrame, *order: str) -> DataFrame:
    """Rows of a bundle in one task, bundles and their rows in the order of the labels."""
    return rows.repartition("tree", "bundle").sortWithinPartitions("tree", "bundle", *order)


def _rise(nodes: DataFrame) -> DataFrame:
    """One round of the forward sweep: the bundles' roots."""

    def run(batches):
        for (tree, bundle), rows in _bundles(batches, ["total", "digest"]):
            total, levels = rows[0][0], _levels_of(rows[0][0])
            digests = [r[1] for r in rows]
            root = digests[0]
            for _, _, root in forward(digests, levels):
                pass
            parents = -(-total // (1 << levels))
            yield pa.RecordBatch.from_arrays([pa.array([x], type=f.type) for x, f in zip((tree, bundle, parents, root), _NODES)], schema=_NODES)

    dealt = _dealt(nodes.select("tree", F.shiftright("place", LEVELS).alias("bundle"), "place", "total", "digest"), "place")
    return dealt.mapInArrow(run, spark_schema(_NODES))


def _meet(nodes: DataFrame, paths: DataFrame, carry: list[str]) -> DataFrame:
    """Nodes of a round behind the path of their bundle, in the order of the labels."""
    none = [F.lit(None).cast(nodes.schema[c].dataType).alias(c) for c in ["total", "digest", *carry]]
    fronts = paths.select("tree", F.col("place").alias("bundle"), F.lit(-1).cast("bigint").alias("place"), "path", "root", *none)
    text = F.lit(None).cast("string")
    rows = nodes.select("tree", F.shiftright("place", LEVELS).alias("bundle"), "place", text.alias("path"), text.alias("root"), "total", "digest", *carry)
    return _dealt(fronts.unionByName(rows), "place")


def _fall(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """One round of the reversed sweep: the paths of a round's nodes from those of their bundles."""

    def run(batches):
        for (tree, _), rows in _bundles(batches, ["place", "path", "root", "total", "digest"]):
            (_, path, root, _, _), own = rows[0], rows[1:]
            base = own[0][0]
            found = list(backward([r[4] for r in own], _levels_of(own[0][3]), path))
            columns = [[tree] * len(found), [base + p for p, _ in found], [s for _, s in found], [root] * len(found)]
            yield pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip(columns, _PATHS)], schema=_PATHS)

    return _meet(nodes, paths, []).mapInArrow(run, spark_schema(_PATHS))


def sweep_up(leaves: DataFrame) -> list[DataFrame]:
    """The nodes at the start of each round, the leaves first, the trees' roots last."""
    rounds = [leaves]
    most = leaves.agg(F.max("total")).first()[0] or 0
    while most > 1:
        rounds.append(stage(_rise(rounds[-1]), "merkle-round"))
        most = -(-most // (1 << LEVELS))
    return rounds


def sweep_down(rounds: list[DataFrame], paths: DataFrame) -> DataFrame:
    """The paths of the second round's nodes, which are the messages to the bundles of the first;
    ``paths`` are those of the last round."""
    for nodes in reversed(rounds[1:-1]):
        paths = stage(_fall(nodes, paths), "merkle-paths")
    return paths


def merkle_manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row.

    Rows where ``tampered`` holds are folded from a leaf with 1 added to n_chars."""
    tampered = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    leaves = docs.select("doc_id", "source", "lang", "n_chars", "text").select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        tree_name(F.col("lang")).alias("tree"),
        leaf_digest(F.col("n_chars")).alias("digest"),
        F.when(tampered, leaf_digest(F.col("n_chars") + 1)).alias("other"),
    )
    leaves = stage(numbered(stage(leaves, "merkle-leaves"), "doc_id", "digest"), "merkle-places")
    rounds = sweep_up(leaves)
    trees = rounds[-1].select(F.lit(TOP).alias("tree"), F.col("tree").alias("name"), "digest")
    trees = stage(numbered(trees, "name"), "merkle-trees")
    above = sweep_up(trees)
    crown = above[-1].select("tree", F.lit(0).cast("bigint").alias("place"), F.lit("").alias("path"), F.col("digest").alias("root"))
    to_trees = sweep_down(above, crown)
    if len(above) > 1:
        to_trees = _fall(trees, to_trees)
    to_trees = to_trees.select("place", "path", "root").join(trees.select("place", "name", "digest"), "place")
    # the root of a tree and the root of all, in one text: they travel together
    to_trees = to_trees.select(F.col("name").alias("tree"), F.lit(0).cast("bigint").alias("place"), "path", F.concat("digest", "root").alias("root"))
    paths = sweep_down(rounds, stage(to_trees, "merkle-paths"))

    def run(batches):
        for _, rows in _bundles(batches, ["place", "path", "root", "total", "digest", "doc_id", "other"]):
            (_, path, roots, *_), own = rows[0], rows[1:]
            subroot, root = roots[:64], roots[64:]
            out = []
            for place, path in backward([r[4] for r in own], _levels_of(own[0][3]), path):
                leaf, doc_id, other = own[place][4:]
                folded = fold(other or leaf, path)
                out.append((doc_id, leaf, subroot, root, digest_of(*[s for _, s in steps(path)]), folded, folded == root))
            yield pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip(zip(*out), _PROOFS)], schema=_PROOFS)

    return _meet(leaves, paths, ["doc_id", "other"]).mapInArrow(run, spark_schema(_PROOFS))
