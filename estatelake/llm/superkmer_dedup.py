"""Removal of word windows that start in an earlier document too, by super-k-mers.

A window is ``WINDOW`` words in a row.  A word is removed if a window over it also starts in a document with a smaller id.

*Packing.*  A window's minimizer is its ``GRAM`` words of least hash.  Windows in a row with one
minimizer travel as one string, a super-k-mer, to the minimizer's bucket, so equal windows meet whatever
documents they are in, and each word is sent about three times instead of ``WINDOW`` times.  Super-k-mers of a
unit of documents that are equal are sent once, from the smallest id; the others are known there and then.

*Hot minimizers.*  One pass over all documents counts minimizers by one super-k-mer in ``SAMPLE``.  Windows
of those that would fill more than a bucket are dealt by the hash of all their words instead, which equal
windows share: so a word sequence that is frequent with ever different surroundings fills no bucket.
The list of these minimizers decides where windows meet and nothing else; it has ``HOT`` entries at most.

*Counting.*  A bucket sorts its windows by a hash of their words; neighbours of equal hash
are compared word by word, and in each class of equal windows those of ids above the smallest are removed.

Defined results: a null text has no words; a null id is smaller than all others; rows that repeat an id are on
a par, as are repeats within a document; a document of fewer words loses nothing; other columns
are ignored; an empty table has no rows.  Rows that repeat an id are told apart by 64 bits of their text's hash.
A bucket holds ``BUCKET`` bytes at any input size, and of windows that are equal, one per unit of documents.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelake.llm.shared import BROADCAST_ROWS, cut_lineage, give_back, tuples
from estatelake.llm.suffix_dedup import squeezed
from estatelake.session import ship_package

WINDOW = 13
GRAM = 3
BUCKET = 1 << 20  # bytes of super-k-mers in a bucket
UNIT = 16 << 20  # bytes of documents whose equal super-k-mers are sent once
BLOCK = 1 << 19  # bytes hashed at a time
PART = 1 << 16  # words of a long document hashed at a time
SAMPLE = 256  # one super-k-mer in so many is counted to find hot minimizers
HOT = 1 << 17
SPAN_BITS = 20  # a span of words is one long: start, then length in this many bits
FIRST = -(1 << 63)  # stands for a null id

# The white space of the word contract.
BLANKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

IS_BLANK = np.isin(np.arange(256), BLANKS)
BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
SPANS = pa.schema([("doc", pa.int64()), ("mark", pa.int64()), ("span", pa.int64())])
PLACE = np.uint64((1 << 24) - 1)  # a word's place in a block, beside 40 bits of a gram's hash


def mixed(x: np.ndarray) -> np.ndarray:
    """Numbers with their bits spread."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def sequence_hash(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each place on that has so many."""
    out = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for i in range(n):
        out = out * np.uint64(BASE) + words[i : i + len(out)]
    return mixed(out)


def packed_words(text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words of a text, each with one blank behind it, with their first places and those of the blanks."""
    raw = np.frombuffer(text + b" ", np.uint8)
    blank = IS_BLANK[raw]
    end = blank.copy()
    end[0] = False
    end[1:] &= ~blank[:-1]
    kept = np.where(end, np.uint8(0x20), raw)[~blank | end]
    stops = np.flatnonzero(end[~blank | end])
    return kept.tobytes(), np.r_[0, stops[:-1] + 1][: len(stops)], stops


@lru_cache(maxsize=4)
def powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of a number modulo 2^64."""
    return np.cumprod(np.r_[np.uint64(1), np.full(n - 1, base, np.uint64)])


def word_hashes(text: bytes, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Hash of each word's bytes: differences of one running sum of a polynomial."""
    n = max(1 << 20, 1 << len(text).bit_length())
    sums = np.r_[np.uint64(0), (np.frombuffer(text, np.uint8) + np.uint64(1)) * powers(BASE, n)[: len(text)]]
    np.cumsum(sums, out=sums)
    return mixed((sums[stops] - sums[starts]) * powers(pow(BASE, -1, 1 << 64), n)[starts])


def parts_of(doc: int, mark: int, text: bytes) -> Iterator[tuple[int, int, int, bytes]]:
    """``(doc, mark, first word, text)`` of a document, a long one in parts; each window lies in one."""
    if len(text) <= BLOCK:
        yield doc, mark, 0, text
        return
    packed, starts, stops = packed_words(text)
    for at in range(0, max(1, len(starts) - WINDOW + 1), PART):
        last = min(len(starts), at + PART + WINDOW - 1) - 1
        if last >= at:
            yield doc, mark, at, packed[starts[at] : stops[last]]


class Superkmers:
    """The super-k-mers of a block of parts: whose they are, first word, windows, key and bytes of each."""

    def __init__(self, parts: list[tuple[int, int, int, bytes]], hot: np.ndarray):
        sizes = np.array([len(p[3]) for p in parts])
        whole = b" ".join(p[3] for p in parts)
        packed, starts, stops = packed_words(whole)
        # The words of each part: those that end before the part does.
        raw = IS_BLANK[np.frombuffer(whole + b" ", np.uint8)]
        ended = np.flatnonzero(raw & ~np.r_[True, raw[:-1]])
        until = np.searchsorted(ended, np.cumsum(sizes + 1) - 1, side="right")
        first = np.r_[0, until[:-1]]
        count = np.maximum(until - first - WINDOW + 1, 0)
        window = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
        part = np.repeat(np.arange(len(parts)), count)
        if not len(window):
            self.part = self.start = self.windows = np.zeros(0, np.int64)
            self.key, self.begin, self.end = np.zeros(0, np.uint64), self.part, self.part
            return
        words = word_hashes(packed, starts, stops)
        grams = sequence_hash(words, GRAM)
        least, width, reach = (grams & ~PLACE) | np.arange(len(grams), dtype=np.uint64), WINDOW - GRAM + 1, 1
        while 2 * reach <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < width:
            least = np.minimum(least[: reach - width], least[width - reach :])
        place = (least & PLACE).astype(np.int64)[window]
        key = grams[place]
        at = np.minimum(np.searchsorted(hot, key), max(0, len(hot) - 1))
        is_hot = hot[at] == key if len(hot) else np.zeros(len(key), bool)
        opens = np.r_[True, (place[1:] != place[:-1]) | (part[1:] != part[:-1])] | is_hot
        head = np.flatnonzero(opens)
        self.windows = np.diff(np.r_[head, len(window)])
        self.key = key[head]
        alone = is_hot[head]
        if alone.any():
            self.key[alone] = sequence_hash(words, WINDOW)[window[head[alone]]]
        self.part = part[head]
        self.start = window[head] - first[self.part] + np.array([p[2] for p in parts])[self.part]
        self.begin, self.end = starts[window[head]], stops[window[head] + self.windows + WINDOW - 2]
        self.packed = packed

    def texts(self) -> list[bytes]:
        return [self.packed[i:j] for i, j in zip(self.begin.tolist(), self.end.tolist(), strict=True)]


def blocks(rows: list[tuple[int, int, bytes]]) -> Iterator[list[tuple[int, int, int, bytes]]]:
    """The parts of documents in blocks of about ``BLOCK`` bytes."""
    held, size = [], 0
    for row in rows:
        for part in parts_of(*row):
            if held and size + len(part[3]) > BLOCK:
                yield held
                held, size = [], 0
            held.append(part)
            size += len(part[3])
    if held:
        yield held


def merged(doc: np.ndarray, mark: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans of words ``doc, mark, span``; those of a text that overlap or touch are put together."""
    if not len(doc):
        return doc, mark, start
    order = np.lexsort((start, mark, doc))
    doc, mark, start, stop = doc[order], mark[order], start[order], stop[order]
    text = np.r_[0, np.cumsum((doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1]))]
    far = stop.max() + 1
    end = np.maximum.accumulate(text * far + stop) - text * far
    head = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (start[1:] > end[:-1])])
    stop = end[np.r_[head[1:] - 1, len(end) - 1]]
    doc, mark, start = doc[head], mark[head], start[head]
    most = (1 << SPAN_BITS) - 1
    times = np.maximum(1, -(-(stop - start) // most))
    nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    doc, mark, start, stop = (np.repeat(x, times) for x in (doc, mark, start, stop))
    start = start + nth * most
    return doc, mark, (start << SPAN_BITS) | (np.minimum(stop, start + most) - start)


def planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte of their rank, which compresses well."""
    return np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()


def from_planes(data: bytes, n: int, at: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8, 8 * n, at).reshape(8, n).T).view("<i8").reshape(n)


def pack_unit(rows: list[tuple[int, int, bytes]], buckets: int, hot: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Payloads of a unit of documents ``(doc, mark, text)`` by bucket: super-k-mers (1 in front), or spans known here (0)."""
    rows = sorted(set(rows))
    seen: dict[bytes, int] = {}
    columns: list[list[np.ndarray]] = [[], [], [], [], []]  # doc, mark, start, windows, bucket
    texts: list[bytes] = []
    known: list[list[np.ndarray]] = [[], [], [], []]
    for parts in blocks(rows):
        cut = Superkmers(parts, hot)
        doc = np.array([p[0] for p in parts], np.int64)[cut.part]
        mark = np.array([p[1] for p in parts], np.int64)[cut.part]
        own = cut.texts()
        earliest = np.array([seen.setdefault(t, d) for t, d in zip(own, doc.tolist(), strict=True)], np.int64)
        old = earliest < doc
        for to, x in zip(known, (doc, mark, cut.start, cut.start + cut.windows + WINDOW - 1), strict=True):
            to.append(x[old])
        bucket = (cut.key % np.uint64(buckets)).astype(np.int64)
        for to, x in zip(columns, (doc, mark, cut.start, cut.windows, bucket), strict=True):
            to.append(x[~old])
        texts += [t for t, o in zip(own, old.tolist(), strict=True) if not o]
    pack = zstandard.ZstdCompressor(level=6)
    if sum(map(len, known[0])):
        gone = merged(*map(np.concatenate, known))
        yield int(gone[0][0]) % buckets, b"\0" + pack.compress(b"".join(map(planes, gone)))  # any bucket will do
    if not texts:
        return
    doc, mark, start, windows, bucket = map(np.concatenate, columns)
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0, True])
    for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        mine = order[i:j]
        numbers = (np.diff(doc[mine], prepend=0), mark[mine], start[mine], windows[mine])
        body = struct.pack("<q", len(mine)) + b"".join(map(planes, numbers)) + b" ".join([texts[k] for k in mine.tolist()])
        yield int(bucket[order[i]]), b"\1" + pack.compress(body)


def solve(payloads: list[bytes]) -> Iterator[pa.RecordBatch]:
    """``doc, mark, span`` of a bucket: the spans known before, and those of windows that also start in a smaller id."""
    unpack, read = zstandard.ZstdDecompressor(), []
    for payload in payloads:
        data = unpack.decompress(payload[1:])
        if payload[0] == 0:
            n = len(data) // 24
            yield pa.record_batch([pa.array(from_planes(data, n, 8 * n * i)) for i in range(3)], SPANS)
            continue
        (n,) = struct.unpack_from("<q", data)
        doc, *more = (from_planes(data, n, 8 + 8 * n * i) for i in range(4))
        read.append((np.cumsum(doc), *more, data[8 + 32 * n :]))
    if read:
        yield pa.record_batch([pa.array(x) for x in repeats(read)], SPANS)


def repeats(read: list[tuple]) -> tuple[np.ndarray, ...]:
    """``doc, mark, span`` of the windows of super-k-mers ``(doc, mark, start, windows, text)`` that also start in a smaller id."""
    doc, mark, start, windows = (np.concatenate([r[i] for r in read]) for i in range(4))
    text, starts, stops = packed_words(b" ".join(r[4] for r in read))
    # The windows: which super-k-mer each is in, and its first word here.
    of = np.repeat(np.arange(len(doc)), windows)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
    held = windows + WINDOW - 1
    word = (np.cumsum(held) - held)[of] + nth
    hashes = sequence_hash(word_hashes(text, starts, stops), WINDOW)[word]
    order = np.argsort(hashes, kind="stable")
    run = np.r_[0, np.cumsum(np.diff(hashes[order]) != 0)]
    several = np.bincount(run)[run] > 1
    order, run = order[several], run[several]
    if not len(order):
        return doc[:0], mark[:0], start[:0]
    # Equal hashes are held against the first of their run word by word; a run that is not one window is sorted out.
    offsets = np.r_[starts, len(text)].astype(np.int32 if len(text) < 1 << 31 else np.int64)
    kind = pa.BinaryArray if offsets.dtype == np.int32 else pa.LargeBinaryArray
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(text)]
    ids = np.asarray(kind.from_buffers(pa.binary() if kind is pa.BinaryArray else pa.large_binary(), len(starts), buffers).dictionary_encode().indices)
    head = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    run = np.repeat(np.arange(len(head)), np.diff(np.r_[head, len(run)]))
    one, other = word[order], word[order][head][run]
    differs = np.zeros(len(run), bool)
    for i in range(WINDOW):
        differs |= ids[one + i] != ids[other + i]
    if differs.any():
        bad = np.isin(run, run[differs])
        _, apart = np.unique(np.stack([ids[one[bad] + i] for i in range(WINDOW)], 1), axis=0, return_inverse=True)
        run[bad] = len(head) + apart.reshape(-1)
        by = np.argsort(run, kind="stable")
        order, run = order[by], run[by]
    head = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    whose = doc[of[order]]
    least = np.repeat(np.minimum.reduceat(whose, head), np.diff(np.r_[head, len(run)]))
    gone = order[whose > least]
    at = start[of[gone]] + nth[gone]
    return merged(doc[of[gone]], mark[of[gone]], at, at + WINDOW)


def units(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, int, bytes]]]:
    """The documents ``(doc, mark, text)`` of a task in units of about ``UNIT`` bytes."""
    unit, size = [], 0
    for batch in batches:
        for row in tuples(batch):
            unit.append(row)
            size += len(row[2])
            if size >= UNIT:
                yield unit
                unit, size = [], 0
    if unit:
        yield unit


def keyed(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """``doc`` (a null id as the smallest), ``mark``, ``bytes`` of the text and ``more``.

    ``mark`` tells rows apart that repeat an id; it is 0 where ids do not repeat, as nearly everywhere, and costs
    nothing then.  Where too many ids repeat to list them, every row has its mark.
    """
    text = F.col(text_col)
    ids = docs.select(F.col(id_col).cast("long").alias("i")).where("i IS NOT NULL")
    again = cut_lineage(ids.groupBy("i").count().where("count > 1").select("i"))
    rows = docs.select(
        F.col(id_col).cast("long").alias("i"), F.xxhash64(text).alias("x"), F.coalesce(text.cast("binary"), F.lit(b"")).alias("bytes"), *more
    )
    mark = F.col("x")
    if again.count() <= BROADCAST_ROWS:  # rows of one number
        rows = rows.join(F.broadcast(again.select(F.col("i").alias("again"))), F.col("i") == F.col("again"), "left")
        mark = F.when(F.col("i").isNull() | F.col("again").isNotNull(), F.col("x")).otherwise(F.lit(0))
    return rows.withColumns({"doc": F.coalesce("i", F.lit(FIRST)), "mark": mark}).drop("i", "x", "again")


def surveyed(rows: DataFrame) -> tuple[int, np.ndarray]:
    """The bytes that all super-k-mers have, and the hot minimizers among them, sorted."""

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, nothing = 0, np.zeros(0, np.uint64)
        for unit in units(batches):
            found = []
            for parts in blocks(unit):
                cut = Superkmers(parts, nothing)
                total += int((cut.end - cut.begin).sum())
                doc = np.array([p[0] for p in parts], np.int64).astype(np.uint64)[cut.part]
                found.append(cut.key[mixed(doc * np.uint64(BASE) + cut.start.astype(np.uint64)) % np.uint64(SAMPLE) == 0])
            keys, counts = np.unique(np.concatenate([nothing, *found]), return_counts=True)
            yield pa.record_batch([pa.array(keys.view(np.int64)), pa.array(counts)], ["key", "n"])
        yield pa.record_batch([pa.array([None], pa.int64()), pa.array([total])], ["key", "n"])
        give_back()

    counts = rows.select("doc", "mark", "bytes").mapInArrow(survey, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    counts = cut_lineage(counts)
    total = counts.where("key IS NULL").agg(F.sum("n")).first()[0] or 0
    least = max(2, BUCKET // (100 * SAMPLE))  # a super-k-mer has about 100 bytes
    listed = counts.where(F.col("key").isNotNull() & (F.col("n") >= least)).orderBy(F.desc("n"), "key").limit(HOT).select("key").collect()
    return total, np.sort(np.array([r[0] for r in listed], np.int64).view(np.uint64))


def repeated_spans(rows: DataFrame) -> DataFrame:
    """``doc, mark, spans``: the removed words of each text that has any, as packed spans (``rows``: see ``keyed``)."""
    ship_package(rows.sparkSession)
    total, hot = surveyed(rows)
    buckets = max(1, -(-total // BUCKET))
    held = rows.sparkSession.sparkContext.broadcast(hot)  # HOT numbers at most

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some: list[tuple[int, bytes]] = []

        def sent() -> pa.RecordBatch:
            numbers, payloads = zip(*some, strict=True)
            some.clear()
            return pa.record_batch([pa.array(numbers, pa.int64()), pa.array(payloads, pa.binary())], ["bucket", "payload"])

        for unit in units(batches):
            for one in pack_unit(unit, buckets, held.value):
                some.append(one)
                if len(some) == 256:
                    yield sent()
        if some:
            yield sent()
        give_back()

    def solved(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([b for b in solve(table.column("payload").to_pylist()) if b.num_rows], SPANS)

    dealt = rows.select("doc", "mark", "bytes").mapInArrow(cut, "bucket long, payload binary")
    found = dealt.groupBy("bucket").applyInArrow(solved, "doc long, mark long, span long")
    return found.groupBy("doc", "mark").agg(F.collect_list("span").alias("spans"))


def cut_words(text: Column, removed: Column) -> Column:
    """``struct<n_words, n_removed, kept>`` of a ``squeezed`` text and its packed spans (null: none)."""

    def cut_one(data: bytes, packed: np.ndarray | None) -> tuple[int, int, bytes]:
        words, kept, at = data.split(), [], 0
        for span in sorted(packed.tolist()) if packed is not None else ():
            start = span >> SPAN_BITS
            kept += words[at:start]
            at = max(at, start + (span & ((1 << SPAN_BITS) - 1)))
        kept += words[at:]
        return len(words), len(words) - len(kept), b" ".join(kept)

    @F.pandas_udf("n_words long, n_removed long, kept binary")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor()
        for texts, spans in batches:
            rows = [cut_one(unpack.decompress(t), s) for t, s in zip(texts, spans, strict=True)]
            yield pd.DataFrame(rows, columns=["n_words", "n_removed", "kept"])
        give_back()

    return cut(text, removed)


def remove_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` (the input row without its text), ``n_words, n_removed, kept`` (words left, one blank between; null for a null text)."""
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row")
    rows = keyed(docs, id_col, text_col, others, F.col(text_col).isNotNull().alias("given"))
    found = repeated_spans(rows).withColumnsRenamed({"doc": "d", "mark": "m"})
    rows = rows.select("doc", "mark", "row", "given", squeezed(F.col("bytes")).alias("packed"))
    joined = rows.join(found, (rows["doc"] == found["d"]) & (rows["mark"] == found["m"]), "left")
    cut = joined.select("row", "given", cut_words(F.col("packed"), F.col("spans")).alias("cut"))
    return cut.select("row", "cut.n_words", "cut.n_removed", F.when(F.col("given"), F.col("cut.kept")).alias("kept"))
