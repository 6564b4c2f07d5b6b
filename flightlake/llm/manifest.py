"""Merkle manifest of a dataset: three-way hash trees per source, folded from retained hash states."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.llm.common import few_or_shuffled, numbered
from flightlake.session import materialise

#: Children of a parent, and levels of the part of a tree that one task call holds.
ARITY = 3
LEVELS = 5
SPAN = ARITY**LEVELS


def field(value: Column) -> Column:
    """A field as the leaf hashes it: ``-`` if null, else UTF-8 byte count, colon and value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(f) for f in fields]).cast("binary"), 256)


class Subtree:
    """The lowest ``levels`` of a tree over hex digests.

    A parent keeps a copy of its hash state before each child slot. Folding another
    digest into a slot resumes that copy with the digest and its right siblings;
    nothing to its left is hashed again.
    """

    def __init__(self, nodes: list[bytes], levels: int):
        self.rows, self.states = [nodes], []
        for _ in range(levels):
            row, states = [], []
            for at in range(0, len(nodes), ARITY):
                state = hashlib.sha256()
                for child in nodes[at : at + ARITY]:
                    states.append(state.copy())
                    state.update(child)
                row.append(state.hexdigest().encode())
            self.states.append(states)
            self.rows.append(row)
            nodes = row

    def path(self, at: int) -> Iterator[tuple[bytes, bytes]]:
        """(siblings to the left, siblings to the right) of a node and of its ancestors."""
        for row in self.rows[:-1]:
            first = at - at % ARITY
            yield b"".join(row[first:at]), b"".join(row[at + 1 : first + ARITY])
            at //= ARITY

    def fold(self, at: int, node: bytes) -> bytes:
        """The digest on top if ``node`` stood at place ``at``."""
        for row, states in zip(self.rows, self.states, strict=False):
            state = states[at].copy()
            state.update(node)
            for sibling in row[at + 1 : at - at % ARITY + ARITY]:
                state.update(sibling)
            node, at = state.hexdigest().encode(), at // ARITY
        return node


def levels_of(nodes: int) -> int:
    """Levels that a part of a tree over ``nodes`` nodes is folded by: all that remain, ``LEVELS`` at most."""
    levels = 0
    while nodes > 1 and levels < LEVELS:
        nodes, levels = -(-nodes // ARITY), levels + 1
    return levels


TREE = "tree int, pos long, nodes long"
PATH = "array<struct<left: string, right: string>>"


def fold_up(nodes: DataFrame) -> DataFrame:
    """The tops of the parts of each tree: (tree, pos, nodes, hash) of SPAN times fewer nodes.

    Parts are of SPAN nodes at most, so a tree of any size is folded by many tasks.
    """

    def top(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("pos")
        count = rows["nodes"][0].as_py()
        part = Subtree([h.encode() for h in rows["hash"].to_pylist()], levels_of(count))
        return pa.table(
            [rows["tree"][:1], [rows["pos"][0].as_py() // SPAN], [-(-count // SPAN)], [part.rows[-1][0].decode()]],
            schema=pa.schema([("tree", pa.int32()), ("pos", pa.int64()), ("nodes", pa.int64()), ("hash", pa.string())]),
        )

    parts = nodes.select("tree", "pos", "nodes", "hash").withColumn("part", F.expr(f"pos div {SPAN}"))
    return parts.groupBy("tree", "part").applyInArrow(top, f"{TREE}, hash string")


def paths_down(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """(tree, pos, path): siblings on the way from each node to the top, given those of the parts' tops."""

    def run(rows: pa.Table, higher: pa.Table) -> pa.Table:
        rows = rows.sort_by("pos")
        part = Subtree([h.encode() for h in rows["hash"].to_pylist()], levels_of(rows["nodes"][0].as_py()))
        rest = higher["path"][0].as_py()
        found = [
            [*({"left": a.decode(), "right": b.decode()} for a, b in part.path(i)), *rest]
            for i in range(rows.num_rows)
        ]
        kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
        return pa.table({"tree": rows["tree"], "pos": rows["pos"], "path": pa.array(found, kind)})

    by = ["tree", "part"]
    parts = nodes.select("tree", "pos", "nodes", "hash").withColumn("part", F.expr(f"pos div {SPAN}"))
    tops = above.select("tree", F.col("pos").alias("part"), "path")
    return parts.groupBy(*by).cogroup(tops.groupBy(*by)).applyInArrow(run, f"tree int, pos long, path {PATH}")


def folded(nodes: DataFrame) -> list[DataFrame]:
    """The trees' node tables from the leaves to their single tops, each stored."""
    tables = [nodes]
    most = nodes.agg(F.max("nodes")).first()[0] or 0
    while most > 1:
        tables.append(materialise(fold_up(tables[-1]), "manifest-nodes"))
        most = -(-most // SPAN)
    return tables


def unfolded(tables: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(tree, pos, path) of the nodes one step above the first table, from the paths of the trees' tops."""
    for nodes in reversed(tables[1:-1]):
        tops = materialise(paths_down(nodes, tops), "manifest-paths")
    return tops


def proofs(leaves: DataFrame, above: DataFrame) -> DataFrame:
    """(id, tree, leaf, proof_sha256, folded_root): each leaf's siblings up to the root, and what its ``changed`` folds to.

    The states before a part's slots, and before its place on every higher level,
    are computed once per part and resumed for each leaf.
    """

    def run(rows: pa.Table, higher: pa.Table) -> pa.Table:
        rows = rows.sort_by("pos")
        part = Subtree([h.encode() for h in rows["hash"].to_pylist()], levels_of(rows["nodes"][0].as_py()))
        steps = [(s["left"].encode(), s["right"].encode()) for s in higher["path"][0].as_py()]
        beyond, before = b"".join(a + b for a, b in steps), [hashlib.sha256(a) for a, _ in steps]
        proof, root = [], []
        for i, changed in enumerate(rows["changed"].to_pylist()):
            siblings = b"".join(a + b for a, b in part.path(i))
            proof.append(hashlib.sha256(siblings + beyond).hexdigest())
            node = part.fold(i, changed.encode())
            for state, (_, right) in zip(before, steps, strict=True):
                state = state.copy()
                state.update(node)
                state.update(right)
                node = state.hexdigest().encode()
            root.append(node.decode())
        return pa.table(
            {"id": rows["id"], "tree": rows["tree"], "leaf": rows["hash"], "proof_sha256": proof, "folded_root": root}
        )

    by, kind = ["tree", "part"], leaves.schema["id"].dataType.simpleString()
    parts = leaves.withColumn("part", F.expr(f"pos div {SPAN}"))
    tops = above.select("tree", F.col("pos").alias("part"), "path")
    return (
        parts.select(*by, "id", "pos", "nodes", "hash", "changed")
        .groupBy(*by)
        .cogroup(tops.groupBy(*by))
        .applyInArrow(run, f"id {kind}, tree int, leaf string, proof_sha256 string, folded_root string")
    )


def manifest(
    docs: DataFrame,
    fields: list[str],
    changed: dict[str, Column] | None = None,
    id_col: str = "doc_id",
    group_col: str = "source",
) -> DataFrame:
    """(id_col, leaf, subroot, root, proof_sha256, folded_root, verified): a row per document.

    A leaf hashes ``fields`` in the order given. Leaves of a group ascend by id,
    null ids first and equal ids by their leaf; groups ascend bytewise, the null
    group first. ``changed`` gives fields in their present state: folded_root is
    what the leaf of those gives with the stored siblings, verified whether that
    is the root. Repeated rows are leaves of their own. An empty table gives no rows.
    """
    now = changed or {}
    leaves = docs.select(
        F.col(id_col).alias("id"),
        F.col(group_col).alias("group"),
        leaf_hash([F.col(f) for f in fields]).alias("hash"),
        leaf_hash([now.get(f, F.col(f)) for f in fields]).alias("changed"),
    )
    leaves = numbered(leaves, ["group", "id", "hash"], "row")
    sizes = materialise(
        leaves.groupBy("group").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("nodes")), "manifest-groups"
    )
    sizes = materialise(numbered(sizes, ["group"], "number"), "manifest-order")
    same = F.col("l.group").eqNullSafe(F.col("g.group"))
    leaves = materialise(
        leaves.alias("l")
        .join(few_or_shuffled(sizes).alias("g"), same)
        .select(
            "id",
            F.col("number").cast("int").alias("tree"),
            (F.col("row") - F.col("first")).alias("pos"),
            "nodes",
            "hash",
            "changed",
        ),
        "manifest-leaves",
    )
    groups = folded(leaves.select("tree", "pos", "nodes", "hash"))
    subroots = materialise(
        groups[-1].select("tree", F.col("hash").alias("subroot")), "manifest-subroots"
    )
    count = sizes.count()
    joint = subroots.select(
        F.lit(0).alias("tree"),
        F.col("tree").cast("long").alias("pos"),
        F.lit(count).cast("long").alias("nodes"),
        F.col("subroot").alias("hash"),
    )
    whole = folded(joint)
    no_path = F.array().cast(PATH)
    root = whole[-1].select("tree", F.lit(0).cast("long").alias("pos"), F.col("hash").alias("root"))
    at_root = root.select("tree", "pos", no_path.alias("path"))
    if len(whole) > 1:
        of_groups = paths_down(joint, unfolded(whole, at_root))
    else:
        of_groups = at_root
    of_tops = materialise(
        of_groups.select(F.col("pos").cast("int").alias("tree"), F.lit(0).cast("long").alias("pos"), "path"),
        "manifest-tops",
    )
    shown = proofs(leaves, unfolded(groups, of_tops)).join(few_or_shuffled(subroots), "tree")
    return shown.withColumn("root", root.select("root").scalar()).select(
        F.col("id").alias(id_col),
        "leaf",
        "subroot",
        "root",
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
