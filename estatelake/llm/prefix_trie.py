"""Trie of conversation prefixes, as balanced parentheses per shard of sorted paths.

*Paths.*  A turn is 16 bytes of the hash of its role and text, a conversation the bytes of its turns put
together: prefixes of the one are prefixes of the other, and texts do not travel.  Equal
conversations are one path with a number of members, however many there are; the numbers of the members are
hashed as a stream in their order, in pieces, so no list of them is ever held.

*Shards.*  Distinct paths are dealt by ranges of their order, ``SHARD`` turns each.  A shard's
paths, in order, give its trie in preorder: each path closes what it does not share with the one before and opens the
rest.  On these parentheses the excess (open less closed) has a minimum and a maximum per
block and a tree over the blocks; ``find_close`` skips whole blocks by them and so delimits each subtree.
Within these bounds the rank of "()" counts childless nodes, differences of cumulative arrays give members
and savings, and the range minimum gives the smallest member.

*Spines.*  A node lies in two shards only if it is on the last path of the one and the first of the
other.  Neighbouring shards exchange how far these two paths agree.  The first shard that has a node owns it:
the others count what is below it, but not the node itself.  Partial rows of such nodes, at most
two paths a shard, are added up; all others are final in their shard.

Defined results: rows without a conversation id belong to no conversation; a null turn comes
first, turns of equal number are in the order of their hash; a null role or text is an empty one; a
conversation without turns is a member of the root; an empty table has no nodes; other columns are ignored.
One conversation's turns (under 100 bytes each) are one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estatelake.llm.shared import cut_lineage, give_back, small, tuples
from estatelake.session import ship_package

SHARD = 1 << 16  # turns of distinct paths in a shard
BLOCK = 64  # parentheses in a block of the excess
TURN = 16  # bytes of a turn in a path
FAR = np.iinfo(np.int64).max

TURNS = "array<struct<said: string, size: int>>"
NODE = pa.schema(
    [("node", pa.binary()), ("above", pa.binary()), ("conv", pa.int64()), ("depth", pa.int64()), ("parent", pa.int64())]
    + [(n, pa.int64()) for n in ("members", "children", "leaves", "saved")]
    + [("ends", pa.string())]
)
NODE_DDL = "node binary, above binary, conv long, depth long, parent long, members long, children long, leaves long, saved long, ends string"


def turn_lists(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turns``: each conversation's turns in order, as the hash and the bytes of text of each."""
    by, said = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    key = F.substring(F.sha2(F.concat(F.octet_length(by).cast("string"), F.lit(":"), by, said).cast("binary"), 256), 1, 2 * TURN)
    turns = rows.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.struct(F.col(turn).alias("turn"), key.alias("said"), F.octet_length(said).alias("size")).alias("one")
    )
    lists = turns.groupBy("conv").agg(F.sort_array(F.collect_list("one")).alias("turns"))
    return lists.select("conv", F.transform("turns", lambda x: F.struct(x["said"], x["size"])).alias("turns"))


def branched(lists: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """``lists`` with the first turns of each conversation taken from the first of its family.

    Conversation c starts with h turns of conversation ``c - c % family`` (none if there is no such one) and
    goes on with its own turns after the first h; h is the CRC-32 of c's decimal digits modulo ``heads``.
    """
    lists = cut_lineage(lists)
    first = lists.where(F.col("conv") % family == 0).select(F.col("conv").alias("base"), F.slice("turns", 1, heads - 1).alias("head"))
    own = lists.withColumns({
        "h": (F.crc32(F.col("conv").cast("string").cast("binary")) % heads).cast("int"),
        "root": F.col("conv") - F.col("conv") % family,
    })
    met = own.join(first, own["root"] == first["base"], "left")
    head = F.slice(F.coalesce("head", F.array().cast(TURNS)), F.lit(1), F.col("h"))
    return met.select("conv", F.concat(head, F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


def paths_of(lists: DataFrame) -> DataFrame:
    """``conv, path, sizes, same``: the path's bytes, the text bytes of its turns, and the path's hash."""
    path = F.unhex(F.array_join(F.transform("turns", lambda x: x["said"]), ""))
    return lists.select("conv", path.alias("path"), F.transform("turns", lambda x: x["size"]).alias("sizes")).withColumn(
        "same", F.unhex(F.sha2("path", 256))
    )


def member_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sorted members of a path, put together as text: one row per path and batch."""
    for batch in batches:
        rows = []
        for same, group in groupby(tuples(batch), key=lambda r: r[0]):
            ids = [conv for _, conv in group]
            rows.append((same, ids[0], len(ids), ",".join(map(str, ids))))
        if rows:
            yield pa.record_batch(list(zip(*rows, strict=True)), pa.schema([("same", pa.binary()), ("conv", pa.int64()), ("n", pa.int64()), ("ids", pa.large_string())]))


def member_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``conv, n, ends`` of each path, from its pieces in order: smallest member, number, hash of all."""
    schema = pa.schema([("conv", pa.int64()), ("n", pa.int64()), ("ends", pa.string())])
    now, first, n, state, done = None, 0, 0, None, []
    for batch in batches:
        for same, conv, some, ids in tuples(batch):
            if same != now:
                if now is not None:
                    done.append((first, n, state.hexdigest()))
                now, first, n, state = same, conv, 0, hashlib.sha256()
            else:
                state.update(b",")
            n += some
            state.update(ids.encode())
        if done:
            yield pa.record_batch(list(zip(*done, strict=True)), schema)
            done = []
    if now is not None:
        yield pa.record_batch([[first], [n], [state.hexdigest()]], schema)


def find_close(excess: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The places of the parentheses that close those open at ``at``: the first later ones with an excess of one less."""
    blocks = -(-len(excess) // BLOCK)
    width = 1 << max(0, blocks - 1).bit_length()
    cells = np.full(width * BLOCK, FAR)
    cells[: len(excess)] = excess
    least, most = [cells.reshape(width, BLOCK).min(1)], [np.where(cells == FAR, -1, cells).reshape(width, BLOCK).max(1)]
    while len(least[-1]) > 1:
        least.append(least[-1].reshape(-1, 2).min(1))
        most.append(most[-1].reshape(-1, 2).max(1))
    wanted = excess[at] - 1
    close = np.full(len(at), -1)

    def scan(who: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Look through the rest of a block from ``start`` on; returns who found nothing."""
        stop = (start // BLOCK + 1) * BLOCK
        while len(who):
            here = cells[start] == wanted[who]
            close[who[here]] = start[here]
            start = start + 1
            go = ~here & (start < stop)
            if not go.all():
                left.append(who[~here & ~go])
                who, start, stop = who[go], start[go], stop[go]
        return np.concatenate(left) if left else who

    left: list[np.ndarray] = []
    inside = (at + 1) % BLOCK != 0
    who = np.arange(len(at))
    rest = np.concatenate([scan(who[inside], at[inside] + 1), who[~inside]]).astype(np.int64)
    # Climb to the first block, or range of blocks, to the right whose excess goes down to the wanted one, then descend.
    node, height = at[rest] // BLOCK, np.full(len(rest), -1)
    for level in range(len(least) - 1):
        up = height < 0
        beside = np.minimum(node + 1, len(least[level]) - 1)
        has = up & (node % 2 == 0) & (least[level][beside] <= wanted[rest]) & (most[level][beside] >= wanted[rest])
        height[has] = level
        node = np.where(has, node + 1, np.where(up, node // 2, node))
    for level in range(len(least) - 1, 0, -1):
        down = height >= level
        node = np.where(down, 2 * node, node)
        right = down & (least[level - 1][np.minimum(node, len(least[level - 1]) - 1)] > wanted[rest])
        node = node + right
    left = []
    scan(rest, node * BLOCK)
    return close


def range_least(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The smallest of ``values`` in each range (none is empty)."""
    out, span, table, size = np.full(len(start), FAR), stop - start, values, 1
    while len(start):
        mine = (span >= size) & (span < 2 * size)
        out[mine] = np.minimum(table[start[mine]], table[stop[mine] - size])
        if 2 * size > len(values):
            break
        table = np.minimum(table[:-size], table[size:])
        size *= 2
    return out


def shared_turns(one: bytes, other: bytes) -> int:
    """How many turns two paths have in common from the start."""
    n = min(len(one), len(other)) // TURN
    a, b = (np.frombuffer(x, "V16", n) for x in (one, other))
    return n if (same := a == b).all() else int(np.argmin(same))


def shard_nodes(rows: list[tuple], before: int, after: int) -> pa.RecordBatch:
    """The nodes of one shard's trie.

    ``rows``: sorted distinct paths as ``(path, sizes, n, conv, ends)``.  ``before`` and ``after``: the turns that the first
    path shares with the shard before and the last with the one behind, -1 if there is none.
    """
    paths, sizes, n, conv, ends = zip(*rows, strict=True)
    length = np.array([len(p) // TURN for p in paths])
    turns = np.frombuffer(b"".join(paths), "<u8").reshape(-1, 2)
    size = np.concatenate([np.zeros(0, np.int64), *[np.asarray(s, np.int64) for s in sizes]])
    head = np.cumsum(length) - length
    # Turns shared with the path before.
    lcp = np.r_[0, np.minimum(length[1:], length[:-1])]
    pair = np.repeat(np.arange(len(paths)), lcp)
    nth = np.arange(len(pair)) - np.repeat(np.cumsum(lcp) - lcp, lcp)
    apart = (turns[head[pair] + nth] != turns[head[pair - 1] + nth]).any(1)
    np.minimum.at(lcp, pair[apart], nth[apart])
    fresh = length - lcp
    count = 1 + int(fresh.sum())
    of = np.repeat(np.arange(len(paths)), fresh)
    last = np.cumsum(fresh)  # the node that each path ends at; the root is node 0
    opened = last - fresh + 1
    depth = np.r_[0, lcp[of] + 1 + np.arange(1, count) - opened[of]]
    said = np.r_[0, size[head[of] + depth[1:] - 1]]
    # Parentheses: close what the path before does not share, open the rest.
    runs = np.zeros((len(paths) + 1, 2), np.int64)
    runs[1:-1, 0], runs[:-1, 1] = length[:-1] - lcp[1:], fresh
    runs[0, 1] += 1
    runs[-1, 0] = length[-1] + 1
    signs = np.repeat(np.tile([-1, 1], len(paths) + 1), runs.ravel())
    at = np.flatnonzero(signs == 1)
    close = find_close(np.cumsum(signs), at)
    stop = np.arange(count) + (close - at + 1) // 2
    # Childless nodes: the rank of "()"; one that goes on in the shard behind is none.
    leaf = (signs == 1) & np.r_[signs[1:] == -1, False]
    if after == length[-1]:
        leaf[at[last[-1]]] = False
    rank = np.r_[0, np.cumsum(leaf)]
    own = np.ones(count, np.int64)
    own[: before + 1] = 0
    ended = np.zeros(count, np.int64)
    ended[last] = n
    total = np.r_[0, np.cumsum(ended)]
    members = total[stop] - total[:-1]
    worth = np.r_[0, np.cumsum((members - own) * said)]
    smallest = np.full(count, FAR)
    smallest[last] = conv
    # Parents: the node before, or for a path's first new node the latest one at the depth where it branches off.
    parent = np.arange(-1, count - 1)
    by_depth = np.lexsort((np.arange(count), depth))
    branch = np.flatnonzero(fresh[1:] > 0) + 1
    rows_at = depth[by_depth] * count + by_depth
    parent[opened[branch]] = by_depth[np.searchsorted(rows_at, lcp[branch] * count + opened[branch]) - 1]
    children = np.bincount(parent[1:], weights=own[1:], minlength=count).astype(np.int64)
    # Nodes shared with a neighbour have a name that holds in all shards.
    names = np.full(count, None, object)
    shared, node = set(range(before + 1)), int(last[-1])
    while node >= 0:
        if depth[node] <= after:
            shared.add(node)
        node = int(parent[node])
    whose = np.r_[0, of]
    for node in shared:
        names[node] = hashlib.blake2b(paths[whose[node]][: TURN * depth[node]], digest_size=TURN).digest()
    above = np.where(parent >= 0, names[parent], None)
    least = range_least(smallest, np.arange(count), stop)
    said_ends = np.full(count, None, object)
    said_ends[last] = ends
    inside = np.array([x is None for x in above]) & (parent >= 0)
    columns = [
        pa.array(names, pa.binary()), pa.array(above, pa.binary()), pa.array(least), pa.array(depth.astype(np.int64)),
        pa.array(least[parent], mask=~inside), pa.array(members), pa.array(children),
        pa.array(rank[close] - rank[at]), pa.array(worth[stop] - worth[:-1]), pa.array(said_ends, pa.string()),
    ]
    return pa.record_batch(columns, NODE)


def borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``shard, before, after``: what each shard's first and last path share with the neighbours'."""
    for batch in batches:
        for shard, first, last, left, right in tuples(batch):
            before = -1 if left is None else shared_turns(left, first)
            after = -1 if right is None else shared_turns(last, right)
            yield pa.record_batch([pa.array([shard], pa.int32()), pa.array([before], pa.int64()), pa.array([after], pa.int64())], ["shard", "before", "after"])


def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of a task's shard."""
    rows, ends = [], (-1, -1)
    for batch in batches:
        for *row, before, after in tuples(batch):
            rows.append(tuple(row))
            ends = before, after
    if rows:
        nodes = shard_nodes(rows, *ends)
        for start in range(0, nodes.num_rows, 10_000):
            yield nodes.slice(start, 10_000)
    give_back()


def trie(lists: DataFrame) -> DataFrame:
    """The nodes of the trie of ``lists`` (columns ``conv, turns``, one row per conversation).

    Returns ``conv, depth, parent, members, children, leaves, saved, ends``: smallest member, depth, the parent's smallest member,
    members, children, childless nodes in the subtree, the bytes of text in the subtree that members beyond the
    first repeat, and the hash of the members that end at the node (null: none).
    """
    ship_package(lists.sparkSession)
    paths = cut_lineage(paths_of(lists))
    sorted_members = paths.select("same", "conv").repartitionByRange("same", "conv").sortWithinPartitions("same", "conv")
    pieces = sorted_members.mapInArrow(member_pieces, "same binary, conv long, n long, ids string")
    kinds = pieces.repartition("same").sortWithinPartitions("same", "conv").mapInArrow(member_hashes, "conv long, n long, ends string")
    distinct = cut_lineage(paths.join(kinds, "conv").select("path", "sizes", "n", "conv", "ends"))
    turns = distinct.agg(F.sum(F.size("sizes"))).first()[0] or 0
    shards = max(1, -(-turns // SHARD))
    dealt = cut_lineage(distinct.repartitionByRange(shards, "path").sortWithinPartitions("path")).withColumn("shard", F.spark_partition_id())
    order = Window.orderBy("shard")  # one row per shard
    edges = dealt.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last"))
    edges = edges.select("shard", "first", "last", F.lag("last").over(order).alias("left"), F.lead("first").over(order).alias("right"))
    near = F.broadcast(edges.mapInArrow(borders, "shard int, before long, after long"))  # three numbers per shard
    rows = dealt.join(near, "shard").select("path", "sizes", "n", "conv", "ends", "before", "after")
    nodes = cut_lineage(rows.mapInArrow(encode, NODE_DDL))
    sums = [F.sum(c).alias(c) for c in ("members", "children", "leaves", "saved")]
    spine = nodes.where("node IS NOT NULL").groupBy("node").agg(
        F.first("above").alias("above"), F.min("conv").alias("conv"), F.first("depth").alias("depth"), *sums, F.max("ends").alias("ends")
    )
    spine = cut_lineage(spine)
    named = small(spine.select(F.col("node").alias("above"), F.col("conv").alias("parent")))  # 24 bytes a row
    columns = ["conv", "depth", "parent", "members", "children", "leaves", "saved", "ends"]
    done = nodes.where("node IS NULL AND above IS NULL").select(*columns)
    below = nodes.where("node IS NULL AND above IS NOT NULL").drop("parent").join(named, "above").select(*columns)
    return done.union(below).union(spine.join(named, "above", "left").select(*columns))
