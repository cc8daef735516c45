"""SimHash near-duplicates found with BK-trees over shards of the fingerprints.

Fingerprints are collapsed first: copies share one.  Two fingerprints that differ in at
most three of 64 bits agree in at least one of four 16-bit blocks, and in at least
one of four parts of what is left; each fingerprint is therefore put into 16 shards
that fix 28 bits, and every linked pair meets in a shard.  A shard that still holds more
than ``SHARD`` fingerprints is split the same way again (37, then 44 bits; a
shard of 44 fixed bits holds 2^20 different fingerprints at most).  No pair is lost.

Each shard is a BK-tree: a child hangs on the edge whose key is its Hamming distance
to the parent, and a search follows only edges within the radius.  All trees of a
task are built and searched level by level in arrays.  A shard answers with a spanning forest
of its links, never with all pairs.

The trees are brought to the tasks by the shuffle instead of a broadcast: they hold
all fingerprints, so their size has no bound.

Defined results: a null or wordless text has fingerprint zero; rows without an id
belong to the component of their fingerprint (whose id is null if no row has one);
repeated rows each get the same result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from estatelake.llm.components import components
from estatelake.llm.shared import cut_lineage, give_back, small, tuples
from estatelake.session import ship_package

SHINGLE = 3
RADIUS = 3
SEED = 42
SHARD = 20_000
PARTS = 4  # one more than the radius, so that one part at least is equal
CHUNK = 1 << 16


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """SimHash of a text: bit by bit, whether over half the shingle hashes have it set."""
    parts = (text or b"").lower().split()  # on bytes: A-Z, and ASCII white space
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(parts))
    first, last = starts[: len(parts) - width + 1].tolist(), ends[width - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, len(first), CHUNK):
        hashes = [xxh64_intdigest(joined[i:j], SEED) for i, j in zip(first[at : at + CHUNK], last[at : at + CHUNK], strict=True)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(first), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc, mark, fp`` (the 64 bits as a signed long) for every row; ``mark`` is a hash of the text."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t, shingle) for (t,) in tuples(batch.select([2]))]
            columns = [batch.column(0), batch.column(1), pa.array(np.array(fps, np.uint64).view(np.int64))]
            yield pa.record_batch(columns, ["doc", "mark", "fp"])
        give_back()

    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(F.col(text_col)).alias("mark"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(hashed, "doc long, mark long, fp long")


def bk_forest(shard: np.ndarray, fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of each shard, by one BK-tree per shard.

    ``shard`` is sorted, ``fps`` are unsigned and distinct within a shard; the
    result is two index arrays (member, smallest member it is linked to through links).
    """
    n = len(fps)
    roots = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
    root = np.repeat(roots, np.diff(np.r_[roots, n]))
    # Building: all members go down one edge per round; the first to take a new edge becomes its child.
    member = np.setdiff1d(np.arange(n), roots, assume_unique=True)
    node, edges, children = root[member], [], []
    while len(member):
        edge = node * 65 + np.bitwise_count(fps[member] ^ fps[node])
        order = np.lexsort((member, edge))
        member, edge = member[order], edge[order]
        new = np.r_[True, edge[1:] != edge[:-1]]
        edges.append(edge[new])
        children.append(member[new])
        node = np.repeat(member[new], np.diff(np.r_[np.flatnonzero(new), len(member)]))[~new]
        member = member[~new]
    edge, child = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (edges, children))
    order = np.argsort(edge)
    edge, child = edge[order], child[order]

    label = np.arange(n)

    def link(a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = label[a], label[b]
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while (label != (up := label[label])).any():
                label[:] = up

    # Searching: every member looks for others within the radius, some members at a time.
    for at in range(0, n, CHUNK):
        query = np.arange(at, min(n, at + CHUNK))
        todo = [(query, root[query])]
        while todo:
            query, node = todo.pop()
            if len(query) > 4 * CHUNK:  # a wide search goes on in halves
                todo += [(query[: len(query) // 2], node[: len(query) // 2]), (query[len(query) // 2 :], node[len(query) // 2 :])]
                continue
            distance = np.bitwise_count(fps[query] ^ fps[node]).astype(np.int64)
            near = (distance <= radius) & (query != node)
            link(query[near], node[near])
            low = np.searchsorted(edge, node * 65 + np.maximum(distance - radius, 0))
            count = np.searchsorted(edge, node * 65 + np.minimum(distance + radius, 64), side="right") - low
            if total := int(count.sum()):
                start = np.repeat(low - np.r_[0, np.cumsum(count)[:-1]], count)
                todo.append((np.repeat(query, count), child[start + np.arange(total)]))
    linked = np.flatnonzero(label != np.arange(n))
    return linked, label[linked]


def split_bits(shards: DataFrame, bits: int, keep: Column | None = None) -> DataFrame:
    """Each row of ``key, rest, fp`` once for each of ``PARTS`` parts of its ``bits`` remaining bits."""
    sizes = [bits // PARTS + (i < bits % PARTS) for i in range(PARTS)]
    cuts, low = [], 0
    for i, size in enumerate(sizes):
        part = F.shiftrightunsigned("rest", low).bitwiseAND(F.lit((1 << size) - 1))
        key = F.shiftleft("key", 2 + size) + F.lit(i << size) + part
        above = F.shiftleft(F.shiftrightunsigned("rest", low + size), low) if low + size < 64 else F.lit(0).cast("long")
        rest = F.col("rest").bitwiseAND(F.lit((1 << low) - 1)) + above
        cuts.append(F.struct(key.alias("key"), rest.alias("rest")))
        low += size
    return shards.select(F.explode(F.array(*cuts)).alias("s"), "fp").select("s.key", "s.rest", "fp")


def shards_of(fps: DataFrame, shard: int = SHARD) -> DataFrame:
    """``key, fp``: shards that every pair within the radius shares at least once."""
    shards = fps.select(F.lit(0).cast("long").alias("key"), F.col("fp").alias("rest"), "fp")
    shards = split_bits(split_bits(shards, 64), 48)
    done = None
    for bits in (36, 27):
        large = cut_lineage(shards.groupBy("key").count().where(F.col("count") > shard).select("key"))
        if large.isEmpty():
            break
        large = small(large)
        rest = shards.join(large, "key", "left_anti")
        done = rest if done is None else done.union(rest)
        shards = split_bits(shards.join(large, "key", "left_semi"), bits)
    return (shards if done is None else done.union(shards)).select("key", "fp")


def near_links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``a, b``: links between distinct fingerprints that keep every component together."""

    def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved(keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
            edge = np.r_[True, keys[1:] != keys[:-1]]
            several = ~(edge & np.r_[edge[1:], True]) if len(keys) else edge[:0]  # a shard of one links nothing
            keys, values = keys[several], values[several].view(np.uint64)
            a, b = bk_forest(keys, values, radius) if len(keys) else (np.zeros(0, int),) * 2
            return pa.record_batch([pa.array(values[x].view(np.int64)) for x in (a, b)], ["a", "b"])

        keys, values = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            keys = np.r_[keys, batch.column(0).to_numpy(zero_copy_only=False)]
            values = np.r_[values, batch.column(1).to_numpy(zero_copy_only=False)]
            if len(keys) > CHUNK and keys[0] != keys[-1]:  # the last shard may go on in the next batch
                whole = int(np.searchsorted(keys, keys[-1]))
                yield solved(keys[:whole], values[:whole])
                keys, values = keys[whole:], values[whole:]
        yield solved(keys, values)
        give_back()

    ship_package(fps.sparkSession)
    shards = shards_of(fps).repartition("key").sortWithinPartitions("key")
    return shards.mapInArrow(forest, "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """``doc, mark, fp, component, kept`` for every row.

    ``component`` is the smallest id reachable over links; ``mark`` is a hash of the text that tells rows apart
    which repeat an id; ``kept`` holds for the least (id, mark) of a component, ids before null.
    """
    if radius >= PARTS:
        raise ValueError(f"a radius of {PARTS - 1} bits at most is exact with {PARTS} parts")
    rows = cut_lineage(fingerprints(docs, id_col, text_col, shingle))
    order = F.struct(F.col("doc").isNull().alias("none"), "doc", "mark")
    distinct = cut_lineage(rows.groupBy("fp").agg(F.min(order).alias("least")))
    linked = components(near_links(distinct.select("fp"), radius))
    rooted = distinct.join(linked, distinct["fp"] == linked["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("first"))
    classes = rooted.join(named, "root").select("fp", "first")
    kept = F.col("doc").eqNullSafe(F.col("first.doc")) & (F.col("mark") == F.col("first.mark"))
    return rows.join(classes, "fp").select("doc", "mark", "fp", F.col("first.doc").alias("component"), kept.alias("kept"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the least (id, text hash) stays, once."""
    # Plain keys without null, so that the join's partitioning serves the grouping too.
    key = lambda c: [F.coalesce(F.col(c), F.lit(-(1 << 63))).alias("key"), F.col(c).isNull().alias("none")]
    kept = near_duplicates(docs, id_col, text_col, **options).where("kept").select(*key("doc"), "mark").distinct()
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(F.col(text_col)).alias("mark"),
    ).select("row", *key("id"), "mark")
    met = rows.join(kept, ["key", "none", "mark"])
    # Rows that repeat both id and text may differ in other columns: the first in order stays.
    return met.groupBy("key", "none", "mark").agg(F.min("row").alias("row")).select("row.*")
