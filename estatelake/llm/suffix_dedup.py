"""Removal of repeated byte strings by suffix arrays over content-placed parts of the text.

A place is removed if it is covered by a string of ``length`` bytes that also starts earlier.

*Placing.*  Every window of ``length`` bytes is sent to the bucket of its minimizer (its
``GRAM``-byte string of least hash), so equal windows meet whatever documents they are in.
Windows in a row with the same minimizer travel as one segment.  Equal segments of a block of
documents are sent once, with their earliest place; the later ones are known to be repeats
there and then, so a passage that very many documents share weighs one segment per block.

*Hot minimizers.*  A string that is common and hashes low gathers windows that are all
different.  A first pass over a sample of the text's pieces lists the minimizers whose segments hold
more than ``HOT`` bytes (the ``LISTED`` heaviest); their windows meet by the minimizer among longer
strings instead (``GRAMS``), and where that one is hot too, by the whole window.  The lists
decide where windows meet and nothing else: equal windows always take the same way.

*Sorting.*  A bucket's segments whose minimizer is not the only one of its kind form one text
with an end mark after each, sorted in two stages: only the suffixes that are smaller than
their successors are sorted directly; every other one is placed by scanning the buckets of
first bytes in order and putting the predecessor of each suffix behind what its own
bucket holds so far.  The scan of a bucket is done in arrays.

*Common prefixes.*  Neighbours in suffix order are compared up to ``length`` bytes; a run of
neighbours that agree so far is one repeated string, and all its places but the earliest are removed.

Results do not depend on how documents are dealt over tasks.  A bucket holds about
``BUCKET`` bytes of windows at any input size, plus, of a passage that many documents share, one
segment per block.  One suffix array covers the segments of a few minimizers, ``SORTED`` bytes or
those of one minimizer, which are about ``HOT`` bytes unless more than ``LISTED`` are as heavy.

Defined results: a null text is an empty one; a null id is smaller than all others;
earlier means a smaller (id, start), so of rows that repeat an id, the places with equal
starts are on a par; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelake.llm.shared import BROADCAST_ROWS, cut_lineage, give_back, tuples
from estatelake.session import ship_package

LENGTH = 100
GRAM = 16
GRAMS = (GRAM, 48)  # bytes of a minimizer, and of that which takes the place of a hot one
PAD = 48  # bytes behind the texts of a block, so that every place has a gram
BUCKET = 1 << 19
SORTED = 1 << 20  # bytes of segments in one suffix array, or those of one minimizer if they are more
UNIT = 8 << 20  # bytes of documents whose equal segments are sent once
HOT = 4 << 20  # bytes of one minimizer's segments beyond which they are dealt anew
LISTED = 1 << 17  # hot minimizers at most, the heaviest
PIECE = 1 << 16  # bytes of the pieces that are sampled to find them
SAMPLE = 16  # one piece in so many
BLOCK = 1 << 18  # bytes hashed at a time; below 2^24, so that a place fits beside 40 bits of hash
PLACE = np.uint64((1 << 24) - 1)
SPAN_BITS = 20  # a span is one long: start, then length in this many bits
KINDS = ("<i8", "<i8", "<i8", "<u2", "<u2")  # of a segment: id (as a difference), start, mark, size, minimizer's place
FIRST = -(1 << 63)  # stands for a null id
UPPER = np.array([(1 << 64) - (1 << (64 - 8 * n)) for n in range(9)], np.uint64)  # masks of the first so many of eight bytes

# Odd multipliers of the hash, from the fractional parts of the golden ratio and of the roots of 2 and 3.
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0x6A09E667F3BCC909, 0xBB67AE8584CAA73B)]


def words_at(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as an integer (a view; ``raw`` needs seven bytes of padding)."""
    return np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))


def gram_hash(words: np.ndarray, at: np.ndarray | slice, gram: int = GRAM) -> np.ndarray:
    """Hash of the ``gram`` bytes from each place on."""

    def read(k: int) -> np.ndarray:
        return words[k:][at] if isinstance(at, slice) else words[at + k]

    mixed = read(0) * MIX[0]
    for k in [*range(8, gram - 7, 8), *([gram - 8] if gram % 8 else [])]:
        mixed ^= mixed >> np.uint64(31)
        mixed += read(k) * MIX[1]
        mixed ^= mixed >> np.uint64(29)
        mixed *= MIX[2]
        mixed ^= mixed >> np.uint64(32)
    return mixed


def run_places(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``counts`` places in a row from each start on."""
    return np.repeat(starts - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum())


def segments(words: np.ndarray, n: int, starts: np.ndarray, counts: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Cut runs of windows into segments: first byte, number of windows, place and hash of the minimizer.

    ``words`` are those of ``n`` bytes and ``PAD`` more.
    """
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    width = length - gram + 1
    hashes = gram_hash(words, slice(0, n), gram)
    least = (hashes & ~PLACE) | np.arange(n, dtype=np.uint64)
    reach = 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
    place = (least & PLACE).astype(np.int64)
    window = run_places(starts, counts)
    place = place[window]
    new = np.r_[True, place[1:] != place[:-1]]
    new[np.cumsum(counts)[:-1]] = True
    opens = np.flatnonzero(new)
    return window[opens], np.diff(np.r_[opens, len(place)]), place[opens], hashes[place[opens]]


def grams(length: int) -> list[int]:
    return [g for g in GRAMS if g < length]


def levels(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, hot: list[np.ndarray]) -> list[tuple[np.ndarray, ...]]:
    """The segments of the texts from ``starts`` to ``ends``, by the gram whose minimizer they have; last, hot windows alone.

    ``raw`` holds the texts and ``PAD`` bytes more; ``hot`` holds, gram by gram, the minimizers whose windows go to the next.
    """
    words, n = words_at(raw), len(raw) - PAD
    whole = ends - starts >= length
    starts, counts = starts[whole], (ends - starts - length + 1)[whole]
    found = []
    for gram, listed in zip(grams(length), hot, strict=False):
        cut = segments(words, n, starts, counts, length, gram)
        again = np.isin(cut[3], listed)
        found.append(tuple(c[~again] for c in cut) if again.any() else cut)
        starts, counts = cut[0][again], cut[1][again]
        if not len(starts):
            return found
    window = run_places(starts, counts) if len(starts) else starts
    found.append((window, np.ones(len(window), np.int64), window, gram_hash(words, window, length)))
    return found


def dealt_segments(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, hot: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """All of ``levels``, in order of their first bytes."""
    found = levels(raw, starts, ends, length, hot)
    if len(found) == 1:
        return found[0]
    head, count, place, hashes = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.argsort(head, kind="stable")
    return head[order], count[order], place[order], hashes[order]


def spans(doc: np.ndarray, mark: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.RecordBatch:
    """Rows ``doc, mark, span`` of removed places; spans of a text that touch are merged."""
    if len(doc):
        order = np.lexsort((start, mark, doc))
        doc, mark, start, stop = doc[order], mark[order], start[order], stop[order]
        same = np.r_[False, (doc[1:] == doc[:-1]) & (mark[1:] == mark[:-1])]
        # Ends rise with starts within a text except where one span lies in another: carry the largest end on.
        text = np.cumsum(~same)
        far = stop.max() + 1
        end = np.maximum.accumulate(text * far + stop) - text * far
        opens = ~same | np.r_[True, start[1:] > end[:-1]]
        first = np.flatnonzero(opens)
        stop = end[np.r_[first[1:] - 1, len(end) - 1]]
        doc, mark, start = doc[first], mark[first], start[first]
        most = (1 << SPAN_BITS) - 1
        if len(stop) and (stop - start).max() > most:
            times = -(-(stop - start) // most)
            nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            doc, mark, stop, start = (np.repeat(x, times) for x in (doc, mark, stop, start))
            start = start + nth * most
            stop = np.minimum(stop, start + most)
    span = (start << SPAN_BITS) | (stop - start)
    return pa.record_batch([pa.array(doc), pa.array(mark), pa.array(span)], ["doc", "mark", "span"])


def cut_unit(
    rows: list[tuple[int, int, bytes]], buckets: int, length: int, hot: list[np.ndarray] | None = None
) -> Iterator[tuple[int, bytes]]:
    """The payloads of a unit of documents ``(doc, mark, text)``: known repeats, and segments by bucket."""
    rows.sort()
    hot = [np.zeros(0, np.uint64)] * len(GRAMS) if hot is None else hot
    step = BLOCK - length + 1  # each window lies in one part
    parts = [(doc, mark, at, text[at : at + BLOCK]) for doc, mark, text in rows for at in range(0, max(1, len(text) - length + 1), step)]
    seen: dict[bytes, int] = {}
    texts: list[bytes] = []
    found: list[tuple[np.ndarray, np.ndarray, list[int]]] = []  # of a block: new segments, old ones, and whose they are
    at = 0
    while at < len(parts):
        size, first = 0, at
        while at < len(parts) and (at == first or size + len(parts[at][3]) <= BLOCK):
            size += len(parts[at][3])
            at += 1
        block = parts[first:at]
        data = b"".join(p[3] for p in block) + bytes(PAD)
        ends = np.cumsum([len(p[3]) for p in block])
        starts = np.r_[0, ends[:-1]]
        head, count, place, hashes = dealt_segments(np.frombuffer(data, np.uint8), starts, ends, length, hot)
        if not len(head):
            continue
        part = np.searchsorted(ends, head, side="right")
        doc = np.array([p[0] for p in block], np.int64)[part]
        mark = np.array([p[1] for p in block], np.int64)[part]
        start = head - starts[part] + np.array([p[2] for p in block], np.int64)[part]
        stop = head + count + (length - 1)
        bucket = ((hashes * MIX[0]) >> np.uint64(33)) % np.uint64(buckets)
        new, old, whose, n = [], [], [], len(texts)
        for i, (a, b) in enumerate(zip(head.tolist(), stop.tolist(), strict=True)):
            text = data[a:b]
            known = seen.setdefault(text, n)
            if known == n:
                texts.append(text)
                new.append(i)
                n += 1
            else:
                old.append(i)
                whose.append(known)
        columns = np.stack([doc, mark, start, place - head, bucket.astype(np.int64), stop - head])
        found.append((columns[:, new], columns[:, old], whose))
    send = [fresh for fresh, _, _ in found]
    sent = np.concatenate(send, axis=1) if send else np.zeros((6, 0), np.int64)
    repeats: list[np.ndarray] = []
    for _, again, whose in found:
        first_ = np.array(whose, np.int64)
        # Places come in the order of (doc, start), except that rows which share an id are on a par.
        later = (again[0] > sent[0, first_]) | (again[0] == sent[0, first_]) & (again[2] > sent[2, first_])
        doc, mark, start, _, _, size = again[:, later]
        repeats.append(np.stack([doc, mark, start, start + size]))
        texts += [texts[i] for i in first_[~later]]
        send.append(again[:, ~later])
    pack = zstandard.ZstdCompressor(level=3)
    if sum(r.shape[1] for r in repeats):
        batch = spans(*np.concatenate(repeats, axis=1))
        sink = b"".join(np.ascontiguousarray(c.to_numpy()).astype("<i8").tobytes() for c in batch.columns)
        yield int(rows[0][0] % buckets), b"\0" + pack.compress(sink)
    if texts:
        doc, mark, start, minimizer, bucket, _ = np.concatenate(send, axis=1)
        order = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0])
        for mine in np.split(order, edges[1:]):
            own = [texts[i] for i in mine]
            sizes = np.array([len(t) for t in own])
            columns = (np.diff(doc[mine], prepend=0), start[mine], mark[mine], sizes, minimizer[mine])
            head_ = b"".join(planes(c, kind) for c, kind in zip(columns, KINDS, strict=True))
            yield int(bucket[mine[0]]), b"\1" + pack.compress(struct.pack("<q", len(mine)) + head_ + b"".join(own))


def planes(values: np.ndarray, kind: str) -> bytes:
    """Numbers byte by byte: all lowest bytes first, which compresses better."""
    return values.astype(kind).view(np.uint8).reshape(len(values), -1).T.tobytes()


def from_planes(data: bytes, kind: str, n: int, at: int) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8, n * width, at).reshape(width, n).T.copy().view(kind).ravel().astype(np.int64)


def byte_order(text: bytes, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The order of the strings ``text[b : b + s]`` by their bytes (of equal ones: any).

    Eight bytes at a time: strings that are still tied go on to their next eight.  Those behind a string's end count as
    zeros, so that it is tied at worst with a longer one that goes on in zeros; of these the shorter one is the smaller.
    """
    if not len(begin):
        return begin
    words = words_at(np.frombuffer(text + bytes(8), np.uint8))

    def read(which: np.ndarray, at: int) -> np.ndarray:
        left = np.clip(size[which] - at, 0, 8)
        word = words[np.minimum(begin[which] + at, len(text))].byteswap()
        return word & UPPER[left]

    word = read(np.arange(len(begin)), 0)
    order = np.argsort(word)
    word = word[order]
    new = np.r_[True, word[1:] != word[:-1]]
    slot = np.arange(len(order))
    for at in [*range(8, int(size.max()), 8), None]:  # last, the sizes
        open_ = new[slot]
        slot = slot[~(open_ & np.r_[open_[1:], True])]  # of ``order``: those that are tied
        if not len(slot):
            break
        which, opens = order[slot], new[slot]
        word = size[which] if at is None else read(which, at)
        differs = ~opens & np.r_[False, word[1:] != word[:-1]]
        # Ties of strings that go on alike, as repeats do, stay as they are.
        group = np.cumsum(opens) - 1
        mixed = np.zeros(group[-1] + 1, bool)
        mixed[group[differs]] = True
        some = np.flatnonzero(mixed[group])
        if len(some):
            by = some[np.lexsort((word[some], group[some]))]
            word = word[by]
            order[slot[some]] = which[by]
            new[slot[some[1:]]] |= word[1:] != word[:-1]
    return order


def suffix_order(text: bytes, heads: np.ndarray, ends: np.ndarray, windows: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the suffixes, in order of their first ``depth`` bytes, from each segment's windows; and their segments.

    Segment ``i`` is ``text[heads[i]:ends[i]]``; its suffixes from the first ``windows[i]`` places
    are wanted (further ones that the second stage needs may come too).  A suffix ends with its
    segment; the end mark is smaller than all bytes.  Two stages, see the module.
    """
    n, many = len(text), len(heads)
    # One symbol per byte and an end mark, 0, per segment; segments lie one after the other.
    marked = np.ones(n + many, bool)
    marked[ends + np.arange(many)] = False
    symbols = np.zeros(n + many + 1, np.int16)
    symbols[:-1][marked] = np.frombuffer(text, np.uint8).astype(np.int16) + 1
    head = heads + np.arange(many)
    total = n + many
    index = np.arange(total, dtype=np.int32)  # far below 2^31 bytes
    last = np.int32(total - 1)
    segment_at = np.repeat(np.arange(many, dtype=np.int32), ends - heads + 1)
    change = np.where(symbols[1:] != symbols[:-1], index, last)
    change = np.minimum.accumulate(change[::-1])[::-1]
    direct = symbols[change + 1] > symbols[change]  # smaller than the successor
    direct |= symbols[:-1] == 0
    following = np.minimum.accumulate(np.where(direct, index, last)[::-1])[::-1]
    edges = np.zeros(total + 1, np.int8)
    edges[head] += 1
    np.subtract.at(edges, following[head + windows] + 1, 1)
    wanted = np.cumsum(edges[:-1], dtype=np.int8) > 0
    del index, change, following, edges

    # First stage: sort the suffixes that are smaller than their successors.
    chosen = np.flatnonzero(direct & wanted)
    segment = segment_at[chosen]
    begin = chosen - segment
    chosen = chosen[byte_order(text, begin, np.minimum(ends[segment] - begin, depth))]

    # Second stage: scan the buckets of first symbols; each suffix places its predecessor.
    induced = wanted & ~direct
    edge = np.searchsorted(symbols[chosen], np.arange(259, dtype=np.int16))
    waiting: list[list[np.ndarray]] = [[] for _ in range(258)]
    order = []
    for symbol in range(258):
        level = np.concatenate(waiting[symbol]) if waiting[symbol] else chosen[:0]
        placed = [level]
        while len(level):  # predecessors with the same first byte follow in this bucket
            level = level[level > 0] - 1
            level = level[induced[level] & (symbols[level] == symbol)]
            placed.append(level)
        placed.append(chosen[edge[symbol] : edge[symbol + 1]])
        bucket = np.concatenate(placed)
        if not len(bucket):
            continue
        order.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[induced[before] & (symbols[before] > symbol)]
        of = symbols[before]
        by = np.argsort(of, kind="stable")
        before, of = before[by], of[by]
        edges = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else []
        for piece, symbol_ in zip(np.split(before, edges[1:]), of[edges], strict=False):
            waiting[symbol_].append(piece)
    order = np.concatenate(order) if order else chosen[:0]
    segment = segment_at[order]
    place = order - segment
    whole = place < heads[segment] + windows[segment]
    return place[whole], segment[whole]


def common_prefix(words: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether each suffix in order shares its first ``length`` bytes with the one before it."""
    alive = np.arange(1, len(order))
    for at in [*range(0, length - 7, 8), length - 8]:
        alive = alive[words[order[alive] + at] == words[order[alive - 1] + at]]
    same = np.zeros(len(order), bool)
    same[alive] = True
    return same


def solve(payloads: list[bytes], length: int) -> Iterator[pa.RecordBatch]:
    """The spans that a bucket's payloads show to be removed."""
    unpack = zstandard.ZstdDecompressor()
    parts = []
    for payload in payloads:
        data = unpack.decompress(payload[1:])
        if payload[:1] == b"\0":
            doc, mark, span = np.frombuffer(data, "<i8").reshape(3, -1)
            yield pa.record_batch([pa.array(doc), pa.array(mark), pa.array(span)], ["doc", "mark", "span"])
            continue
        (n,) = struct.unpack_from("<q", data)
        read, at = [], 8
        for kind in KINDS:
            read.append(from_planes(data, kind, n, at))
            at += np.dtype(kind).itemsize * n
        parts.append((np.cumsum(read[0]), *read[1:], data[at:]))
    if not parts:
        return
    doc, start, mark, size, minimizer = (np.concatenate([p[i] for p in parts]) for i in range(5))
    text = b"".join(p[5] for p in parts)
    del parts
    ends = np.cumsum(size)
    heads = ends - size
    words = words_at(np.frombuffer(text + bytes(GRAM), np.uint8))
    # A minimizer that stands alone stands in no repeated window.
    hashes = gram_hash(words, heads + minimizer)
    order = np.argsort(hashes)
    edge = np.r_[True, hashes[order][1:] != hashes[order][:-1]]
    several = ~(edge & np.r_[edge[1:], True])
    order, hashes = order[several], hashes[order[several]]
    if not len(order):
        return
    # Minimizers are taken together as long as their segments stay within ``SORTED`` bytes.
    first = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
    total = np.cumsum(np.add.reduceat(size[order], first))
    at = 0
    while at < len(first):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + SORTED, side="right")))
        mine = np.sort(order[first[at] : first[to] if to < len(first) else len(order)])
        own = b"".join([text[i:j] for i, j in zip(heads[mine].tolist(), ends[mine].tolist(), strict=True)])
        yield repeated(own, doc[mine], start[mine], mark[mine], size[mine], length)
        at = to


def repeated(text: bytes, doc: np.ndarray, start: np.ndarray, mark: np.ndarray, size: np.ndarray, length: int) -> pa.RecordBatch:
    """The spans to be removed that segments (one after the other in ``text``) show among themselves."""
    ends = np.cumsum(size)
    heads = ends - size
    order, segment = suffix_order(text, heads, ends, size - length + 1, length)
    words = words_at(np.frombuffer(text + bytes(8), np.uint8))
    same = common_prefix(words, order, length)
    run = np.cumsum(~same)
    several = same.copy()
    several[:-1] |= same[1:]
    order, run, segment = order[several], run[several], segment[several]
    of, at = doc[segment], start[segment] + order - heads[segment]
    by = np.lexsort((at, of, run))
    run, of, at, segment = run[by], of[by], at[by], segment[by]
    opens = np.flatnonzero(np.r_[True, run[1:] != run[:-1]]) if len(run) else run
    first = np.repeat(opens, np.diff(np.r_[opens, len(run)]))
    gone = (of != of[first]) | (at != at[first])
    return spans(of[gone], mark[segment[gone]], at[gone], at[gone] + length)


def whole_id(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(FIRST))


def repeated_ids(docs: DataFrame, id_col: str) -> DataFrame:
    """``again``: ids of more than one row, up to one more than are broadcast."""
    ids = docs.groupBy(whole_id(id_col).alias("again")).agg(F.count("*").alias("n")).where("n > 1")
    return cut_lineage(ids.select("again").limit(BROADCAST_ROWS + 1))


def keyed(docs: DataFrame, id_col: str, text_col: str, again: DataFrame, *more: Column) -> DataFrame:
    """``doc`` (a null id as the smallest), ``mark``, ``bytes`` of the text and ``more``.

    ``mark`` tells rows apart that repeat an id: 64 bits of the text's hash, 0 for an id that stands alone (or is not in a
    list of such ids because that would be too long to broadcast: then all rows have their hash).
    """
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    rows = docs.select(whole_id(id_col).alias("doc"), text.alias("bytes"), *more)
    mark = F.xxhash64("bytes")
    if again.count() <= BROADCAST_ROWS:
        rows = rows.join(F.broadcast(again), F.col("doc") == F.col("again"), "left")
        mark = F.when(F.col("again").isNotNull(), mark).otherwise(F.lit(0).cast("long"))
    return rows.select("doc", mark.alias("mark"), *[c for c in rows.columns if c not in ("doc", "again")])


def weighed(pieces: list[bytes], length: int, hot: list[np.ndarray]) -> pa.RecordBatch:
    """``hash, size``: bytes of the different segments of each minimizer of the last gram that ``hot`` leads to."""
    data = b"".join(pieces) + bytes(PAD)
    ends = np.cumsum([len(p) for p in pieces])
    cut = levels(np.frombuffer(data, np.uint8), np.r_[0, ends[:-1]], ends, length, [*hot, np.zeros(0, np.uint64)])
    head, count, _, hashes = cut[-1] if len(cut) > len(hot) else (c[:0] for c in cut[-1])
    stop = head + count + (length - 1)
    once = {data[a:b]: i for i, (a, b) in enumerate(zip(head.tolist(), stop.tolist(), strict=True))}
    mine = np.fromiter(once.values(), np.int64, len(once))
    keys, whose = np.unique(hashes[mine], return_inverse=True)
    sizes = np.bincount(whose, (stop - head)[mine], len(keys)).astype(np.int64)
    return pa.record_batch([pa.array(keys.view(np.int64)), pa.array(sizes)], ["hash", "size"])


def hot_minimizers(rows: DataFrame, length: int, total: int) -> list[np.ndarray]:
    """Gram by gram, the hashes of the minimizers whose segments hold more than ``HOT`` bytes, from a sample of the pieces."""
    hot: list[np.ndarray] = []
    for _ in grams(length):
        if total * length < HOT or (hot and not len(hot[-1])):
            hot.append(np.zeros(0, np.uint64))
            continue
        known = list(hot)

        def weigh(batches: Iterator[pa.RecordBatch], known: list[np.ndarray] = known) -> Iterator[pa.RecordBatch]:
            held, size = [], 0
            for batch in batches:
                for doc, mark, text in tuples(batch):
                    for at in range(0, len(text) - length + 1, PIECE):
                        if zlib.crc32(b"%d %d %d" % (doc, mark, at)) % SAMPLE:
                            continue
                        held.append(text[at : at + PIECE + length - 1])
                        size += len(held[-1])
                        if size >= BLOCK:
                            yield weighed(held, length, known)
                            held, size = [], 0
            if held:
                yield weighed(held, length, known)
            give_back()

        sizes = rows.mapInArrow(weigh, "hash long, size long").groupBy("hash").agg(F.sum("size").alias("size"))
        heavy = sizes.where(F.col("size") * SAMPLE > HOT).orderBy(F.desc("size"), "hash").limit(LISTED).select("hash")
        hot.append(np.sort(np.array([r[0] for r in heavy.collect()], np.int64).view(np.uint64)))
    return hot


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, again: DataFrame | None = None
) -> DataFrame:
    """``doc, mark, spans``: the removed places of each text that has any, as sorted packed spans."""
    if length < GRAM + 1:
        raise ValueError(f"strings must be longer than {GRAM} bytes")
    ship_package(docs.sparkSession)
    rows = keyed(docs, id_col, text_col, repeated_ids(docs, id_col) if again is None else again).select("doc", "mark", "bytes")
    total = int(docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0)
    buckets = max(1, -(-total // BUCKET))
    hot = hot_minimizers(rows, length, total)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent(unit: list[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
            held: list[tuple[int, bytes]] = []
            for bucket, payload in cut_unit(unit, buckets, length, hot):
                held.append((bucket, payload))
                if len(held) == 256:
                    yield packed(held)
                    held = []
            if held:
                yield packed(held)

        def packed(held: list[tuple[int, bytes]]) -> pa.RecordBatch:
            numbers, payloads = zip(*held, strict=True)
            return pa.record_batch([pa.array(numbers, pa.int64()), pa.array(payloads, pa.binary())], ["bucket", "payload"])

        unit, size = [], 0
        for batch in batches:
            for row in tuples(batch):
                unit.append(row)
                size += len(row[2])
                if size >= UNIT:
                    yield from sent(unit)
                    unit, size = [], 0
        if unit:
            yield from sent(unit)
        give_back()

    def solved(table: pa.Table) -> pa.Table:
        found = [b for b in solve(table.column("payload").to_pylist(), length) if b.num_rows]
        schema = pa.schema([("doc", pa.int64()), ("mark", pa.int64()), ("span", pa.int64())])
        return pa.Table.from_batches(found, schema)

    dealt = rows.mapInArrow(cut, "bucket long, payload binary")
    found = dealt.groupBy("bucket").applyInArrow(solved, "doc long, mark long, span long")
    return found.groupBy("doc", "mark").agg(F.array_sort(F.collect_list("span")).alias("spans"))


def squeezed(text: Column) -> Column:
    """Texts (binary) compressed one by one, for the shuffle."""

    @F.pandas_udf("binary")
    def squeeze(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pack = zstandard.ZstdCompressor(level=3)
        for texts in batches:
            yield pd.Series([pack.compress(t) for t in texts], dtype=object)
        give_back()

    return squeeze(text)


def cut_out(text: Column, removed: Column, whole_characters: bool = False) -> Column:
    """``struct<n_bytes, n_removed, n_spans, kept>`` of a ``squeezed`` text and its packed spans (null: none).

    With ``whole_characters``, what is left of a character that loses some of its bytes is not in ``kept`` either.
    """

    def cut_one(data: bytes, packed: np.ndarray | None) -> tuple[int, int, int, bytes]:
        kept, end, runs, at = [], 0, 0, 0
        if packed is not None:
            for span in packed.tolist():
                start, stop = span >> SPAN_BITS, (span >> SPAN_BITS) + (span & ((1 << SPAN_BITS) - 1))
                if start > end or not runs:
                    runs += 1
                    kept.append(data[at:start])
                end = at = max(end, stop)
        kept.append(data[at:])
        left = b"".join(kept)
        gone = len(data) - len(left)
        if whole_characters and gone:
            # Run by run, or halves of two characters would make a third.
            left = b"".join(run.decode("utf-8", "ignore").encode() for run in kept)
        return len(data), gone, runs, left

    @F.pandas_udf("n_bytes long, n_removed long, n_spans long, kept binary")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor()
        for texts, removed in batches:
            rows = [cut_one(unpack.decompress(t), r) for t, r in zip(texts, removed, strict=True)]
            yield pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept"])
        give_back()

    return cut(text, removed)


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, whole_characters: bool = False
) -> DataFrame:
    """``row`` (the input row without its text), ``n_bytes, n_removed, n_spans, kept`` (the bytes left; null for a null text)."""
    again = repeated_ids(docs, id_col)
    found = repeated_spans(docs, id_col, text_col, length, again).withColumnsRenamed({"doc": "d", "mark": "m"})
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row")
    rows = keyed(docs, id_col, text_col, again, others, F.col(text_col).isNotNull().alias("given"))
    rows = rows.select("doc", "mark", "row", "given", squeezed(F.col("bytes")).alias("packed"))
    joined = rows.join(found, (rows["doc"] == found["d"]) & (rows["mark"] == found["m"]), "left")
    cut = joined.select("row", "given", cut_out(F.col("packed"), F.col("spans"), whole_characters).alias("cut"))
    return cut.select("row", "cut.n_bytes", "cut.n_removed", "cut.n_spans", F.when(F.col("given"), F.col("cut.kept")).alias("kept"))
