"""Merkle manifest of a dataset by time-forward processing (operator 12).

Rows are the leaves of one tree for each group; the groups' roots are the leaves
of a last tree.  A node's *label* is (level, place).  Nodes are worked off in
the order of their labels: a node takes its children's digests out of a priority
queue that is ordered by label, and puts its own in under its parent's label.

The queue is external: it is a table, and a shuffle delivers the messages whose
labels lie in one *block*, a subtree of ``LEVELS`` levels above consecutive
nodes, to one task, which goes on with a heap.  A block has at most
``FAN ** LEVELS`` leaves, so a group of any size is many blocks, and a forest of
n leaves takes log(n) / log(FAN ** LEVELS) rounds.

The second sweep runs the other way: the queue is ordered by falling labels and
a node hands its proof suffix, the digests beside its path to the root, to its
children.  One suffix travels to each block, never one to each leaf.
"""

from __future__ import annotations

import hashlib
import heapq
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..context import materialize
from ..operators.joins import sized
from . import common

#: Children of a node.
FAN = 3
#: Levels that one block spans.
LEVELS = 6
BLOCK = FAN**LEVELS
#: Rows one task puts in order.
ROWS_PER_TASK = 1_000_000


def framed(value: Column) -> Column:
    """A value as it enters a leaf's digest: ``-`` if NULL, else its UTF-8 bytes behind their number."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts, one behind the other."""
    return F.sha2(F.concat(*parts), 256)


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def _grow(digests: list[str], levels: int | None) -> tuple[str, list[tuple[int, int, list[str]]]]:
    """Work off a block's nodes by label: the digest at its top, and the runs of children met, in that order.

    ``levels`` is how many levels the block has; None stands for "until one node is left".
    """
    queue = [((0, place), child) for place, child in enumerate(digests)]  # ascending, so a heap already
    runs: list[tuple[int, int, list[str]]] = []
    while True:
        (level, place), child = heapq.heappop(queue)
        if level == levels or (levels is None and not queue):
            return child, runs
        run, parent = [child], (level + 1, place // FAN)
        while queue and queue[0][0][0] == level and queue[0][0][1] // FAN == place // FAN:
            run.append(heapq.heappop(queue)[1])
        runs.append((*parent, run))
        heapq.heappush(queue, (parent, _hash("".join(run))))


def _hand_down(n: int, runs: list[tuple[int, int, list[str]]], lefts: list[str], rights: list[str]) -> list[tuple[list[str], list[str]]]:
    """Deliver suffixes from a block's top, whose own is given, to its ``n`` leaves, by falling label."""
    if not runs:
        return [(lefts, rights)] * n
    queue = [((-runs[-1][0], -runs[-1][1]), lefts, rights)]
    out: list = [None] * n
    for level, place, run in reversed(runs):
        label, lefts, rights = heapq.heappop(queue)
        assert label == (-level, -place)
        for i in range(len(run)):
            child = (["".join(run[:i]), *lefts], ["".join(run[i + 1 :]), *rights])
            if level == 1:
                out[place * FAN + i] = child
            else:
                heapq.heappush(queue, ((1 - level, -(place * FAN + i)), *child))
    return out


def _numbered(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Add ``place``: the 0-based place of each row in its group, ordered by ``order``; NULLs come first.

    Rows are range-partitioned by (group, order) and written down with their
    partition; each partition counts its own rows and adds the rows of its group in
    the partitions before.  So a group that holds most rows is many tasks' work.
    """
    pieces = max(1, -(-rows.count() // ROWS_PER_TASK))
    pieces = max(pieces, rows.sparkSession.sparkContext.defaultParallelism)
    by = [*[F.col(c) for c in group], *[F.col(c) for c in order]]
    cut = rows.repartitionByRange(pieces, *by).withColumn("_piece", F.spark_partition_id())
    cut = materialize(cut, "merkle-pieces")
    counts = cut.groupBy("_piece", *group).agg(F.count(F.lit(1)).alias("_n"))
    counts = materialize(counts, "merkle-counts")
    # A group that is cut lies in consecutive pieces: at most two groups of a piece go on in another one, so the
    # rows that are added up here are few, whatever the groups' sizes and number.
    before = Window.partitionBy(*group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).filter("_before > 0").drop("_n")
    names = {c: f"_on_{c}" for c in [*group, "_piece"]}
    offsets = materialize(offsets.withColumnsRenamed(names), "merkle-offsets")
    inside = Window.partitionBy("_piece", *group).orderBy(*order)
    local = cut.withColumn("_local", F.row_number().over(inside) - 1)
    on = [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]
    joined = local.join(sized(offsets), on, "left")
    return joined.withColumn("place", (F.col("_local") + F.coalesce("_before", F.lit(0))).cast("long")).drop("_local", "_before", "_piece", *names.values())


_NODES = "tree long, place long, digest string"
_SUFFIX = "tree long, place long, lefts array<string>, rights array<string>"


def _types(df: DataFrame, columns: list[str]) -> list[str]:
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [f"{c} {kinds[c]}" for c in columns]


def _blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("place") / BLOCK).cast("long"))


def _climb(nodes: DataFrame) -> DataFrame:
    """One round of the first sweep: the digest at the top of each block, at the block's place.

    ``nodes`` has ``tree, place, digest, size``; ``size`` is the tree's number of nodes on this level.
    """
    schema = common.arrow_schema(_NODES)

    def top(key, table):
        table = table.sort_by("place")
        found, _ = _grow(table.column("digest").to_pylist(), LEVELS if table.column("size")[0].as_py() > BLOCK else None)
        return pa.table([pa.array([k.as_py()], pa.int64()) for k in key] + [pa.array([found])], schema=schema)

    return _blocks(nodes.select("tree", "place", "digest", "size")).groupBy("tree", "block").applyInArrow(top, _NODES)


def _descend(nodes: DataFrame, tops: DataFrame, own: list[str], told: list[str]) -> DataFrame:
    """One round of the second sweep: each node of a level with its suffix.

    ``tops`` has the blocks' own: ``tree, place, lefts, rights``.  ``own`` names
    further columns of ``nodes``, and ``told`` those of ``tops`` that every node
    below gets.
    """
    ddl = ", ".join([_SUFFIX, *_types(nodes, own), *_types(tops, told)])
    schema = common.arrow_schema(ddl)

    def down(nodes, top):
        if not nodes.num_rows or not top.num_rows:
            return schema.empty_table()
        nodes, n = nodes.sort_by("place"), nodes.num_rows
        _, runs = _grow(nodes.column("digest").to_pylist(), LEVELS if nodes.column("size")[0].as_py() > BLOCK else None)
        found = _hand_down(n, runs, top.column("lefts")[0].as_py(), top.column("rights")[0].as_py())
        made = {"lefts": [f[0] for f in found], "rights": [f[1] for f in found]}
        made |= {c: [top.column(c)[0].as_py()] * n for c in told}
        columns = [pa.array(made[f.name], f.type) if f.name in made else nodes.column(f.name).cast(f.type) for f in schema]
        return pa.Table.from_arrays(columns, schema=schema)

    base = ["tree", "place", "digest", "size"]
    below = _blocks(nodes.select(*base, *[c for c in own if c not in base])).groupBy("tree", "block")
    above = tops.withColumnRenamed("place", "block").groupBy("tree", "block")
    return below.cogroup(above).applyInArrow(down, ddl)


@dataclass(frozen=True)
class _Forest:
    """Trees by every ``LEVELS``-th level, from the leaves on: ``tree, place, digest, size``."""

    levels: list[DataFrame]
    roots: DataFrame  # tree, digest

    def proofs(self, of_roots: DataFrame, own: list[str], told: list[str]) -> DataFrame:
        """Suffixes of all leaves, given those of the roots (``tree, lefts, rights`` and ``told``)."""
        start = of_roots.withColumn("place", F.lit(0).cast("long")).select("tree", "place", "lefts", "rights", *told)
        top = start
        for nodes in reversed(self.levels[1:]):
            found = _descend(nodes, top, [], told)
            # Trees that end below enter there; theirs is the one block.
            ended = start.join(sized(nodes.select("tree").distinct()), "tree", "left_anti")
            top = materialize(found.unionByName(ended), "merkle-suffixes")
        return _descend(self.levels[0], top, own, told)


def _grown(leaves: DataFrame) -> _Forest:
    """The first sweep over ``tree, place, digest`` and any further columns."""
    sizes = materialize(leaves.groupBy("tree").agg(F.count(F.lit(1)).alias("size")), "merkle-sizes")
    levels, roots = [], []
    nodes = leaves
    while not sizes.isEmpty():
        levels.append(nodes.join(sized(sizes), "tree"))
        made = materialize(_climb(levels[-1]), "merkle-nodes")
        sizes = sizes.withColumn("size", F.ceil(F.col("size") / BLOCK).cast("long"))
        roots.append(made.join(sized(sizes.filter("size = 1").select("tree")), "tree", "left_semi").select("tree", "digest"))
        sizes = materialize(sizes.filter("size > 1"), "merkle-sizes")
        nodes = made
    found = roots[0]
    for more in roots[1:]:
        found = found.unionByName(more)
    return _Forest(levels, materialize(found, "merkle-roots"))


def manifest(
    rows: DataFrame,
    leaf: Column,
    group_col: str = "source",
    id_col: str = "doc_id",
    keep: dict[str, Column] | None = None,
) -> DataFrame:
    """One row for each row: id, group, ``leaf, subroot, root, lefts, rights`` and the columns of ``keep``.

    ``lefts`` and ``rights`` are the proof: for each level the digests beside the
    path, left and right of it, in hex and one behind the other.  Leaves of a
    group ascend by id, NULL first; rows that share an id by their digest.  A NULL
    group is a group like another and comes first.  A group of one row has its
    leaf as subroot, and a dataset of one group has its subroot as root.  Texts
    are read once and do not travel; other columns are left behind.  An empty table
    gives none.
    """
    common.ship(rows.sparkSession, 4096)
    extra = keep or {}
    named = [F.col(f"`{group_col}`").cast("string").alias("_group"), F.col(f"`{id_col}`").alias("_id"), leaf.alias("digest")]
    leaves = materialize(rows.select(*named, *[c.alias(f"_keep_{n}") for n, c in extra.items()]), "merkle-leaves")
    kept = [f.name for f in leaves.schema.fields if f.name.startswith("_keep_")]
    # Trees are numbered in the order of their groups, so a number stands for a group from here on.
    groups = _numbered(leaves.select("_group").distinct().withColumn("_one", F.lit(1)), ["_one"], ["_group"])
    groups = materialize(groups.select(F.col("_group").alias("_name"), F.col("place").alias("tree")), "merkle-groups")
    treed = leaves.join(sized(groups), F.col("_group").eqNullSafe(F.col("_name"))).drop("_name")
    placed = materialize(_numbered(treed.drop("_group"), ["tree"], ["_id", "digest", *kept]), "merkle-placed")
    if placed.isEmpty():
        none = F.array().cast("array<string>")
        empty = placed.select(F.col("_id").alias(id_col), F.lit("").alias(group_col), *[F.col("digest").alias(c) for c in ("leaf", "subroot", "root")], none.alias("lefts"), none.alias("rights"), *[F.col(c).alias(c[6:]) for c in kept])
        return empty
    small = _grown(placed)
    subroots = materialize(small.roots.join(sized(groups), "tree"), "merkle-subroots")
    last = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), "digest", F.col("tree").alias("of"), F.col("_name").alias("group"))
    large = _grown(materialize(last, "merkle-last"))
    root = large.roots.first()["digest"]  # one row
    nothing = F.array().cast("array<string>")
    above = large.proofs(large.roots.select("tree", nothing.alias("lefts"), nothing.alias("rights")), ["of", "group", "digest"], [])
    above = above.select(F.col("of").alias("tree"), "lefts", "rights", "group", F.col("digest").alias("subroot"))
    proofs = small.proofs(materialize(above, "merkle-subroot-suffixes"), ["_id", "digest", *kept], ["group", "subroot"])
    return proofs.select(
        F.col("_id").alias(id_col),
        F.col("group").alias(group_col),
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(root).alias("root"),
        "lefts",
        "rights",
        *[F.col(c).alias(c[6:]) for c in kept],
    )


def siblings(lefts: Column | str = "lefts", rights: Column | str = "rights") -> Column:
    """All digests of a proof in one text, level by level, left to right."""
    return F.array_join(F.zip_with(lefts, rights, lambda a, b: F.concat(a, b)), "")


def fold(leaf: Column | str, lefts: Column | str = "lefts", rights: Column | str = "rights") -> Column:
    """The root that a leaf and a proof lead to."""
    pairs = F.arrays_zip(F.col(lefts) if isinstance(lefts, str) else lefts, F.col(rights) if isinstance(rights, str) else rights)
    start = F.col(leaf) if isinstance(leaf, str) else leaf
    return F.aggregate(pairs, start, lambda acc, x: digest(x["lefts"], acc, x["rights"]))
