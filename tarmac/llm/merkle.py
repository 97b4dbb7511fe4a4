"""Operator 13: Merkle manifest of a dataset, checkpoint-and-recompute.

Every group of rows has a tree: its leaves ascend by the order columns, and
while several nodes remain, every ``ARITY`` consecutive ones become the hash
of their concatenation.  The roots of all groups, in order of their names,
are the leaves of one more such tree.

Of a tree only every ``LEVELS``-th level is stored, as rows of ``SPAN``
aligned consecutive nodes (a block).  A proof needs the siblings on the way
up: each block makes the levels between its stored nodes and their common
ancestor again, adds the siblings found there to the path of that ancestor,
which came down from the stored level above, and forgets them.  So a level
costs one join of blocks with paths, and no row holds more than a block and
one path.

Places within a group come from one range sort over all rows and the counts
of each sorted piece, so a group may hold most rows.  Nulls stand first in
every order; rows that are equal in all order columns stand in the order of
their hashes, and rows that are equal in everything are interchangeable.  A
null column hashes as ``-``, an empty text as ``0:``; texts may have any
length.  An empty table gives no rows.  Other columns are left out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import materialise

ARITY = 3
#: Levels from one stored level to the next, and nodes in a block of the lower one.
LEVELS = 4
SPAN = ARITY ** LEVELS
#: Powers of the arity that a count of 63 bits can reach.
_POWERS = [ARITY ** i for i in range(40)]
_EMPTY_PATH = "CAST(array() AS array<struct<left: string, right: string>>)"


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf(columns: dict[str, Column]) -> Column:
    """Hash of a row: each value with its length in UTF-8 bytes before it, ``-`` for null."""
    parts = []
    for value in columns.values():
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return digest(F.concat(*parts))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows with ``idx``, their place in their ``grp`` by ``order``, and ``n``, the size of the group.

    One range exchange sorts all rows.  A row's place is its place in the
    sorted piece plus the rows of its group in the pieces before, which are
    running sums over one count per piece and group.
    """
    spark = rows.sparkSession
    rows = rows.withColumn("_tie", F.monotonically_increasing_id())  # so that equal rows can be dealt to several pieces
    rows = materialise(spark, rows, "leaves")
    by = ["grp", *order, "_tie"]
    pieces = rows.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie")
    pieces = materialise(spark, pieces.withColumn("_at", F.monotonically_increasing_id()), "sorted")
    piece, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    pieces = pieces.withColumns({"_piece": piece, "_place": place}).drop("_at")
    counts = pieces.groupBy("grp", "_piece").agg(F.count(F.lit(1)).alias("n"), F.min("_place").alias("first"))
    until = F.sum("n").over(Window.partitionBy("grp").orderBy("_piece"))
    shifts = counts.select("grp", "_piece", (until - F.col("n") - F.col("first")).alias("_shift"),
                           F.sum("n").over(Window.partitionBy("grp")).alias("n"))
    return pieces.join(shifts, ["grp", "_piece"]).withColumn("idx", F.col("_place") + F.col("_shift")).drop(
        "_piece", "_place", "_shift")


def _blocks(nodes: DataFrame, keep: list[str]) -> DataFrame:
    """``grp, n, block, nodes``: ``SPAN`` consecutive nodes a row, in order."""
    return nodes.groupBy("grp", "n", F.floor(F.col("idx") / SPAN).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("idx", "node", *keep))).alias("nodes"))


def _levels() -> Column:
    """Levels from the stored nodes of a block up to its ancestor: fewer where the group's root is near."""
    return F.least(F.lit(LEVELS), reduce(lambda a, b: a + b, [(F.col("n") > p).cast("int") for p in _POWERS]))


def _recomputed(blocks: DataFrame) -> DataFrame:
    """Blocks with ``up`` (levels to climb) and ``l0`` to ``l4``, the nodes of each level."""
    out = blocks.withColumn("up", _levels()).withColumn("l0", F.col("nodes.node"))
    for i in range(LEVELS):
        out = out.withColumn(f"l{i + 1}", F.when(F.col("up") > i, _parents(F.col(f"l{i}"))).otherwise(F.col(f"l{i}")))
    return out


def _parents(nodes: Column) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / ARITY).cast("int"))
    return F.transform(runs, lambda j: digest(F.concat_ws("", F.slice(nodes, j * ARITY + 1, F.lit(ARITY)))))


def build(nodes: DataFrame, keep: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """Stored levels (blocks, leaves first) and ``grp, node, top``: each group's root and the level of its last block.

    ``nodes``: ``grp, idx, n, node`` and the columns ``keep`` of the leaves.
    """
    spark = nodes.sparkSession
    most = 0
    stored, roots = [], None
    while not stored or most > SPAN:
        level = materialise(spark, _blocks(nodes, [] if stored else keep), f"level-{LEVELS * len(stored)}")
        most = level.agg(F.max("n")).first()[0] or 0
        tops = _recomputed(level).select("grp", "n", "block", F.col(f"l{LEVELS}")[0].alias("node"))
        done = tops.filter(F.col("n") <= SPAN).select("grp", "node", F.lit(len(stored)).alias("top"))
        roots = done if roots is None else roots.union(done)
        stored.append(level)
        nodes = tops.filter(F.col("n") > SPAN).select(
            "grp", F.col("block").alias("idx"), F.ceil(F.col("n") / SPAN).alias("n"), "node")
    return stored, roots


def _siblings(i: Column, level: int) -> Column:
    """Nodes left and right of leaf ``i``'s ancestor in its run, null where the tree has no such level."""
    own = F.floor(i / ARITY ** level).cast("int")
    first = F.floor(own / ARITY).cast("int") * ARITY
    nodes = F.col(f"l{level}")
    return F.when(F.col("up") > level, F.struct(
        F.concat_ws("", F.slice(nodes, first + 1, own - first)).alias("left"),
        F.concat_ws("", F.slice(nodes, own + 2, first + ARITY - 1 - own)).alias("right")))


def paths(stored: list[DataFrame], above: DataFrame, carried: list[str]) -> DataFrame:
    """``grp, node, path`` of every leaf with its own columns and those ``carried`` by the group.

    ``above``: ``grp, top, path`` and the carried columns of each group's root.
    A path holds the concatenated siblings left and right of every step up.
    """
    rows = None
    for i in reversed(range(len(stored))):
        level = _recomputed(stored[i])
        upper = above.filter(F.col("top") == i).select("grp", F.lit(0).cast("long").alias("block"), "path", *carried)
        if rows is not None:
            upper = upper.union(rows.select("grp", F.col("x.own.idx").alias("block"), "x.path", *carried))
        joined = level.join(upper, ["grp", "block"])
        steps = F.transform("nodes", lambda own, at: F.struct(own.alias("own"), F.concat(
            F.filter(F.array(*(_siblings(at, k) for k in range(LEVELS))), lambda s: s.isNotNull()),
            F.col("path")).alias("path")))
        rows = joined.select("grp", F.explode(steps).alias("x"), *carried)
    return rows.select("grp", "x.own.*", "x.path", *carried).drop("idx")


def proof(path: Column) -> Column:
    """Hash of all siblings from the leaf to the root, left to right."""
    return digest(F.aggregate(path, F.lit(""), lambda text, s: F.concat(text, s["left"], s["right"])))


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda node, s: digest(F.concat(s["left"], node, s["right"])))


def manifest(docs: DataFrame, columns: list[str], group: str = "source", order: str = "doc_id",
             changed: dict[str, Column] | None = None) -> DataFrame:
    """``order, leaf, altered, subroot, root, path`` of every row.

    ``altered`` is the row's leaf with the ``changed`` values in place of its own.
    """
    own = {c: F.col(c) for c in columns}
    # a text that sorts as the group does, byte by byte, with null first
    rows = docs.select(
        F.coalesce(F.concat(F.lit("."), F.col(group).cast("string")), F.lit("")).alias("grp"),
        F.col(order).alias("key"), leaf(own).alias("node"), leaf(own | (changed or {})).alias("altered"))
    stored, roots = build(numbered(rows, ["key", "node"]), ["key", "altered"])
    roots = materialise(rows.sparkSession, roots, "subroots")
    names = roots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "node", "top")
    top_stored, top_roots = build(numbered(names, ["name"]), ["name", "top"])
    start = top_roots.select("grp", "top", F.expr(_EMPTY_PATH).alias("path"), F.col("node").alias("root"))
    sources = paths(top_stored, start, ["root"]).select(
        F.col("name").alias("grp"), "top", "path", F.col("node").alias("subroot"), "root")
    return paths(stored, sources, ["subroot", "root"]).select(
        F.col("key").alias(order), F.col("node").alias("leaf"), "altered", "subroot", "root", "path")


def summary(docs: DataFrame, columns: list[str], changed: dict[str, Column], group: str = "source",
            order: str = "doc_id") -> DataFrame:
    """Digest of each row's proof, and whether the altered leaf still gives the root."""
    rows = manifest(docs, columns, group, order, changed)
    folded = fold(F.col("altered"), F.col("path"))
    return rows.select(order, "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"),
                       folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
