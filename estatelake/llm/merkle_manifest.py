"""Merkle manifest of a table: a hash tree per group of rows, and one over the groups.

*Order.*  Rows are dealt by ranges of (group, key) and sorted there, and a row's place is its place
in its task plus the rows of the tasks before; so a group that holds a third of the table
is spread like all others.  Only hashes and keys travel, never the columns that are hashed.

*Slot pivot.*  A node's children are ``FANOUT`` consecutive nodes.  Conditional aggregates spread
them into that many slot columns of one row; the hash of the columns put together is the node, and
for each child the columns before and after its own are its siblings.  A level has a
``FANOUT``-th of the rows of the one below, and the next one is made of it until each group has one node left.

*Proofs.*  From the root down, each row hands its path to the children in its slots, with their own
siblings in front.  A path is an array of ``(before, after)``, from the leaf's run up to the root.

Defined results: a null column is ``-``, and differs from an empty one; a null key or group comes
first; rows that repeat a key are in the order of their hash, and equal rows have the same leaf and
places next to each other; a group of one row has that leaf as its subroot, and one group alone has its
subroot as root; an empty table has no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estatelake.llm.shared import cut_lineage

FANOUT = 16
BROADCAST_BYTES = 16 << 20  # the largest table of groups that is broadcast; a larger one is joined by a shuffle

STEP = "array<struct<before: string, after: string>>"


def digest(*columns: Column) -> Column:
    """Lower-case hex SHA-256 of columns put together."""
    return F.sha2(F.concat(*columns).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the bytes of the value's text, a colon and the text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    """The leaf of a row with these values."""
    return digest(*[field(v) for v in values])


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``nth``, their place from 0 in ``order`` (nulls first), counted over all tasks."""
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    dealt = tied.repartitionByRange(*order, "tie").sortWithinPartitions(*order, "tie").drop("tie")
    held = cut_lineage(dealt).withColumn("at", F.monotonically_increasing_id())
    held = held.withColumns({"task": F.shiftright("at", 33), "at": F.col("at").bitwiseAND(F.lit((1 << 33) - 1))})
    # One row for each task, whatever the size of the table.
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = held.groupBy("task").agg(F.count("*").alias("size"))
    tasks = tasks.select("task", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("passed"))
    return held.join(F.broadcast(tasks), "task").withColumn("nth", F.col("passed") + F.col("at")).drop("task", "passed", "at")


def pivot(nodes: DataFrame, fanout: int) -> DataFrame:
    """One row per run of nodes (``tree, pos, n, cell``): its children in slot columns, their number in the tree, its hash.

    The only node of a tree is handed on as it is.
    """
    slots = [F.expr(f"first(CASE WHEN pos % {fanout} = {s} THEN cell END, true)").alias(f"slot_{s}") for s in range(fanout)]
    runs = nodes.groupBy("tree", F.floor(F.col("pos") / fanout).cast("long").alias("pos")).agg(F.max("n").alias("n"), *slots)
    joined = digest(*[F.coalesce(F.col(f"slot_{s}.hash"), F.lit("")) for s in range(fanout)])
    return cut_lineage(runs.withColumn("hash", F.when(F.col("n") == 1, F.col("slot_0.hash")).otherwise(joined)))


def climb(runs: DataFrame, fanout: int) -> DataFrame:
    """The nodes that ``pivot`` has made, as the level above."""
    return runs.select("tree", "pos", F.ceil(F.col("n") / fanout).cast("long").alias("n"), F.struct("hash").alias("cell"))


def levels(nodes: DataFrame, fanout: int) -> list[DataFrame]:
    """The levels of the trees over ``nodes``, from the lowest, until each tree has one node."""
    made = [pivot(nodes, fanout)]
    while (made[-1].agg(F.max("n")).first()[0] or 0) > fanout:
        made.append(pivot(climb(made[-1], fanout), fanout))
    return made


def hand_down(level: DataFrame, paths: DataFrame, fanout: int) -> DataFrame:
    """The children of a level's rows with their paths: ``paths`` of the level's own nodes, one step longer."""
    said = [f"coalesce(slot_{s}.hash, '')" for s in range(fanout)]
    slots = ", ".join(
        f"struct({s} AS slot, slot_{s} AS cell, concat('', {', '.join(said[:s]) or "''"}) AS before, concat('', {', '.join(said[s + 1 :]) or "''"}) AS after)"
        for s in range(fanout)
    )
    runs = level.select("tree", "pos", "n", F.expr(f"filter(array({slots}), x -> x.cell IS NOT NULL)").alias("children"))
    kept = [c for c in paths.columns if c not in ("tree", "pos", "path", "cell")]
    met = runs.join(paths.select("tree", "pos", "path", *kept), ["tree", "pos"]).withColumn("child", F.explode("children"))
    step = F.when(F.col("n") == 1, F.array().cast(STEP)).otherwise(F.array(F.struct("child.before", "child.after")).cast(STEP))
    return met.select(
        "tree", (F.col("pos") * fanout + F.col("child.slot")).alias("pos"), "child.cell", F.concat(step, "path").alias("path"), *kept
    )


def manifest(
    rows: DataFrame,
    key: str,
    group: str,
    columns: Sequence[str],
    carry: Mapping[str, Column] | None = None,
    fanout: int = FANOUT,
) -> DataFrame:
    """``key, leaf, subroot, root, path`` of every row, and ``carry`` (columns made of the row) as a struct ``more``."""
    more = F.struct(F.lit(0).alias("_"), *[c.alias(n) for n, c in (carry or {}).items()])
    leaves = rows.select(
        F.col(group).alias("grp"), F.col(key).alias("key"), leaf([F.col(c) for c in columns]).alias("hash"), more.alias("more")
    )
    placed = numbered(cut_lineage(leaves), ["grp", "key", "hash"])
    groups = placed.groupBy("grp").agg(F.count("*").alias("n"), F.min("nth").alias("first"))
    trees = cut_lineage(numbered(groups, ["grp"]).withColumnRenamed("nth", "tree"))
    many, size = trees.agg(F.count("*"), F.sum(F.coalesce(F.octet_length(F.col("grp").cast("string")), F.lit(0)))).first()
    near = F.broadcast(trees) if many * 64 + (size or 0) <= BROADCAST_BYTES else trees
    cells = placed.join(near.withColumnRenamed("grp", "g"), F.col("grp").eqNullSafe(F.col("g"))).select(
        "tree", (F.col("nth") - F.col("first")).alias("pos"), "n", F.struct("hash", "key", "more").alias("cell")
    )
    below = levels(cells, fanout)
    subroots = climb(below[-1], fanout).select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(many).alias("n"), "cell")
    above = levels(subroots, fanout)
    paths = above[-1].select("tree", "pos", F.array().cast(STEP).alias("path"), F.col("hash").alias("root"))
    for level in reversed(above):
        paths = hand_down(level, paths, fanout)
    paths = paths.select(F.col("pos").alias("tree"), F.lit(0).cast("long").alias("pos"), "path", "root", F.col("cell.hash").alias("subroot"))
    for level in reversed(below):
        paths = hand_down(level, paths, fanout)
    return paths.select("cell.key", F.col("cell.hash").alias("leaf"), "subroot", "root", "path", "cell.more")


def siblings(path: Column) -> Column:
    """A path's siblings put together, from the leaf's run up, left to right."""
    return F.array_join(F.transform(path, lambda x: F.concat(x["before"], x["after"])), "")


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings on its path."""
    return F.aggregate(path, start, lambda h, x: digest(x["before"], h, x["after"]))
