"""Embedding near-duplicates by lattice hashing.

Each of ``TABLES`` tables projects the unit vectors to eight dimensions at random, times
``SCALE``, and decodes the result to the nearest point of the E8 lattice: the cell.  A
vector is stored in its own cell and asks there and in the ``PROBES`` neighbouring cells
(of the 240 nearest lattice neighbours) that its residual points to.  Pairs that
meet are compared by their vectors rounded to bytes, with a bound on the rounding error, so that no
pair at or above the threshold is lost there; what remains is verified by the cosine in double precision.

Measured against brute force, pairs at a cosine of just 0.9 are found with probability 0.98 by
the default tables, pairs above 0.95 nearly always (tests/llm/test_lattice_neardup.py).

Equal vectors are collapsed first and counted with their number of copies.  A cell that
holds, or is asked by, more than ``CELL`` vectors is dealt into blocks of about so many, and
each pair of blocks is compared for itself, so that no group holds more than two blocks.  Which
cells are large is counted on a sample of the vectors; it decides where pairs meet and nothing else.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components, and
vectors without an id, link with nothing (no links, own id as component); vectors of
different lengths never link; rows that repeat an id are vectors of their own, each with the links
and the component of its own vector, so a row is never a link of itself; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.llm.components import components
from estatelake.llm.shared import cut_lineage, small
from estatelake.session import ship_package

COSINE = 0.9
TABLES = 8
PROBES = 4
SCALE = 0.8
CELL = 2_000
SURVEY = 16  # one vector in so many is posted to count the cells, more where cells are small
BYTES = 1 << 24  # of either side of the pairs compared at once


def roots() -> np.ndarray:
    """The 240 lattice points nearest to zero: two coordinates of +-1, or eight of +-1/2 with an even number of minus signs."""
    whole = [[x if k == i else y if k == j else 0 for k in range(8)] for i, j in combinations(range(8), 2) for x in (1, -1) for y in (1, -1)]
    half = [s for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(whole + half, float)


def nearest_even(x: np.ndarray) -> np.ndarray:
    """The nearest integer points with an even sum."""
    point = np.rint(x)
    off = x - point
    odd = np.flatnonzero(point.sum(axis=1) % 2 != 0)
    worst = np.abs(off[odd]).argmax(axis=1)
    point[odd, worst] += np.where(off[odd, worst] >= 0, 1, -1)
    return point


def decode(x: np.ndarray) -> np.ndarray:
    """The nearest E8 points: even-sum integers, or those shifted by a half."""
    whole, half = nearest_even(x), nearest_even(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(closer[:, None], whole, half)


def cells(units: np.ndarray, tables: int, probes: int, scale: float) -> Iterator[tuple[int, np.ndarray]]:
    """For each table, the keys of each vector's own cell (column 0) and of the cells it probes."""
    neighbours = roots()
    for table in range(tables):
        random = np.random.default_rng([table, units.shape[1]])
        projected = units @ random.standard_normal((units.shape[1], 8)) * scale
        mix = random.integers(1, 1 << 62, 8) * 2 + 1
        own = decode(projected)
        towards = (projected - own) @ neighbours.T
        order = np.argsort(-towards, axis=1, kind="stable")[:, :probes]
        points = np.concatenate([own[:, None], own[:, None] + neighbours[order]], axis=1)
        yield table, ((2 * points).astype(np.int64) * mix).sum(axis=2) ^ (table << 56)


def unit_vectors(rows: DataFrame) -> DataFrame:
    """Distinct valid vectors of ``id, vec``: ``node``, ``least`` (id), ``copies``, ``vec, hash, unit`` (vec scaled to length 1).

    ``node`` is a number of the vector's own, which holds once the rows are written.
    """
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = F.col("id").isNotNull() & F.col("vec").isNotNull() & fine & F.exists("vec", lambda x: x != 0)
    distinct = rows.where(valid).groupBy("hash", "vec").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    most = F.array_max(F.transform("vec", F.abs))
    scaled = distinct.withColumn("scaled", F.transform("vec", lambda x: x / most))
    norm = F.sqrt(F.aggregate("scaled", F.lit(0.0), lambda s, x: s + x * x))
    return scaled.withColumn("norm", norm).select(
        F.monotonically_increasing_id().alias("node"), "least", "copies", "vec", "hash", F.transform("scaled", lambda x: x / F.col("norm")).alias("unit")
    )


def postings(vectors: DataFrame, tables: int, probes: int, scale: float) -> DataFrame:
    """``cell, stored, node, code, error``: where each vector is stored and where else it asks."""

    def posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column(0).to_numpy(zero_copy_only=False)
            lists = batch.column(1)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            values, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            for size in np.unique(sizes):
                mine = np.flatnonzero(sizes == size)
                units = values[offsets[mine][:, None] + np.arange(size)]
                codes = np.rint(units * 127).astype(np.int8)
                # Rounded up, so that a bound made of it holds.
                errors = np.linalg.norm(units - codes / 127, axis=1).astype(np.float32) * np.float32(1.0001) + np.float32(1e-6)
                packed = [c.tobytes() for c in codes]
                for _, keys in cells(units, tables, probes, scale):
                    for i in range(keys.shape[1]):
                        yield pa.record_batch(
                            [pa.array(keys[:, i]), pa.array(np.full(len(mine), i == 0)), pa.array(nodes[mine]), pa.array(packed, pa.binary()), pa.array(errors)],
                            ["cell", "stored", "node", "code", "error"],
                        )

    ship_package(vectors.sparkSession)
    return vectors.select("node", "unit").mapInArrow(posted, "cell long, stored boolean, node long, code binary, error float")


def close_pairs(cell: np.ndarray, stored: np.ndarray, asks: np.ndarray, node: np.ndarray, codes: list[bytes], errors: np.ndarray, cosine: float) -> np.ndarray:
    """Pairs of nodes (smaller first) of equal cells that may reach ``cosine``; rows are sorted by cell, stored ones first."""
    edges = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    ends = np.r_[edges[1:], len(cell)]
    held = np.add.reduceat(stored.astype(np.int64), edges)
    first, count = np.repeat(edges, ends - edges), np.repeat(held, ends - edges)
    asking = np.flatnonzero(asks & (count > 0))
    found = [np.zeros((0, 2), np.int64)]
    sizes = np.array([len(c) for c in codes])
    total = np.cumsum(count[asking])
    pairs = max(1, BYTES // (4 * int(sizes.max(initial=1))))
    at = 0
    while at < len(asking):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + pairs, side="right")))
        some = asking[at:to]
        at = to
        left = np.repeat(some, count[some])
        nth = np.arange(len(left)) - np.repeat(np.cumsum(count[some]) - count[some], count[some])
        right = first[left] + nth
        use = (node[left] != node[right]) & (sizes[left] == sizes[right])
        left, right = left[use], right[use]
        for size in np.unique(sizes[left]):
            mine = sizes[left] == size
            a, b = left[mine], right[mine]
            rows, where = np.unique(np.r_[a, b], return_inverse=True)
            matrix = np.frombuffer(b"".join([codes[i] for i in rows.tolist()]), np.int8).reshape(len(rows), size).astype(np.float32)
            x, y = matrix[where[: len(a)]], matrix[where[len(a) :]]
            dot = np.einsum("ij,ij->i", x, y) / np.float32(127 * 127)
            slack = errors[a] + errors[b] + errors[a] * errors[b] + np.float32(1e-4)
            near = dot >= np.float32(cosine) - slack
            pair = np.stack([np.minimum(node[a[near]], node[b[near]]), np.maximum(node[a[near]], node[b[near]])], axis=1)
            found.append(np.unique(pair, axis=0))
    return np.unique(np.concatenate(found), axis=0)


def dealt_cells(posted: DataFrame, cell_size: int, survey: DataFrame | None = None, one_in: int = 1) -> DataFrame:
    """``cell, part, stored, asks, node, code, error``: every vector that is stored in a part meets every one that asks there.

    Stored vectors of a large cell are dealt into blocks, and so are those that only ask.  A part is a pair of blocks, the
    first of stored vectors, and holds about two times ``cell_size`` vectors at most.  Cells are counted on ``survey``, the
    postings of one vector ``one_in`` so many (all of ``posted`` if not given).
    """
    counted = (posted if survey is None else survey).groupBy("cell")
    sizes = counted.agg((F.count_if("stored") * one_in).alias("n"), (F.count_if(~F.col("stored")) * one_in).alias("m"))
    blocks = lambda c: F.greatest(F.ceil(F.col(c) / cell_size), F.lit(int(one_in > 1))).cast("int")
    large = sizes.where((F.col("n") > cell_size) | (F.col("m") > cell_size))
    large = cut_lineage(large.select(F.col("cell").alias("large"), blocks("n").alias("p"), blocks("m").alias("q")))
    dealt = posted.join(small(large), F.col("cell") == F.col("large"), "left")
    # Blocks of stored vectors have the numbers below p, the others those from there on.
    own = F.when(F.col("stored"), F.pmod(F.xxhash64("node"), "p")).otherwise(F.col("p") + F.pmod(F.xxhash64("node"), "q")).cast("int")
    dealt = dealt.withColumn("own", own)
    all_blocks = F.when(F.col("p") == 0, F.array().cast("array<int>")).otherwise(
        F.sequence(F.lit(0), F.when(F.col("stored"), F.col("p") + F.col("q") - 1).otherwise(F.col("p") - 1))
    )
    dealt = dealt.withColumn("other", F.explode(F.when(F.col("large").isNull(), F.array(F.lit(0))).otherwise(all_blocks)))
    first, second = F.least("own", "other"), F.greatest("own", "other")
    part = F.when(F.col("large").isNull(), F.lit(0).cast("long")).otherwise(F.shiftleft(first.cast("long"), 32) + second)
    whole = F.col("large").isNull()
    return dealt.select(
        "cell",
        part.alias("part"),
        F.when(whole, F.col("stored")).otherwise(F.col("own") == first).alias("stored"),
        (whole | (F.col("own") == second)).alias("asks"),
        "node",
        "code",
        "error",
    )


def candidates(
    posted: DataFrame, cosine: float, cell_size: int = CELL, *, vectors: DataFrame | None = None, post: Callable | None = None
) -> DataFrame:
    """``a, b``: distinct pairs that meet in a cell and may reach ``cosine``.

    With ``vectors`` and ``post`` (which makes ``posted`` of them), large cells are found by a sample of the vectors.
    """
    if vectors is None or post is None:
        dealt = dealt_cells(posted, cell_size)
    else:
        one_in = max(1, min(SURVEY, cell_size // 64))
        dealt = dealt_cells(posted, cell_size, post(vectors.where(F.pmod(F.xxhash64("node"), F.lit(one_in)) == 0)), one_in)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(table: pa.Table) -> pa.RecordBatch:
            cell, part, stored, asks, node, _, errors = (
                c.to_numpy() if i != 5 else None for i, c in enumerate(table.columns)
            )
            both = np.cumsum(np.r_[0, (cell[1:] != cell[:-1]) | (part[1:] != part[:-1])]) if len(cell) else cell
            found = close_pairs(both, stored, asks, node, table.column(5).to_pylist(), errors, cosine)
            return pa.record_batch([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            waiting.append(batch)
            cell, part = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            last = int(np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]) | (part[1:] != part[:-1])])[-1])
            if last:  # the last cell may go on in the next batch
                yield pairs(pa.Table.from_batches([*waiting[:-1], batch.slice(0, last)]))
                waiting = [batch.slice(last)]
        if waiting:
            yield pairs(pa.Table.from_batches(waiting))

    ordered = dealt.repartition("cell", "part").sortWithinPartitions("cell", "part", F.desc("stored"))
    return ordered.mapInArrow(compared, "a long, b long").distinct()


def near_vectors(
    embeddings: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    cosine: float = COSINE,
    tables: int = TABLES,
    probes: int = PROBES,
    scale: float = SCALE,
) -> tuple[DataFrame, DataFrame]:
    """``(rows, links)``: ``id, n_links, component`` per row, and the verified links ``a, b, cosine`` between distinct vectors."""
    rows = embeddings.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.withColumn("hash", F.xxhash64("vec"))
    vectors = cut_lineage(unit_vectors(rows))
    post = lambda some: postings(some, tables, probes, scale)
    pairs = candidates(post(vectors), cosine, vectors=vectors, post=post)
    dot = F.aggregate(F.zip_with("ua", "ub", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    side = lambda end: vectors.select(
        F.col("node").alias(end), F.col("least").alias(f"id_{end}"), F.col("unit").alias(f"u{end}")
    )
    links = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "id_a", "id_b", dot.alias("cosine"))
    links = cut_lineage(links.where(F.col("cosine") >= cosine))
    nodes = vectors.select("node", "least", "copies")
    ends = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a"))
    linked = (
        ends.join(nodes.select(F.col("node").alias("other"), "copies"), "other").groupBy("node").agg(F.sum("copies").alias("linked"))
    )
    rooted = components(links.select("a", "b")).join(nodes.select("node", "least"), "node")
    least = rooted.groupBy("root").agg(F.min("least").alias("root_id"))
    named = rooted.join(least, "root").select("node", "root_id")
    known = (
        nodes.join(linked, "node", "left")
        .join(named, "node", "left")
        .select("node", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.coalesce("root_id", "least").alias("component"))
    )
    placed = vectors.select("hash", "vec", "node").join(known, "node").withColumnsRenamed({"hash": "h", "vec": "v"})
    out = rows.join(placed, (F.col("hash") == F.col("h")) & (F.col("vec") == F.col("v")) & F.col("id").isNotNull(), "left")
    return (
        out.select(
            "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component")
        ),
        links.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"), "cosine"),
    )
