"""Best-fit packing of token sequences by minimum bin slack.

Documents are tokenized into pieces of at most ``size`` tokens.  The plan needs only
the histogram of piece lengths (at most ``size`` rows, whatever the corpus): per
bin, the longest length left is set, and a subset-sum over bitsets of the lengths
left finds the fullest combination beside it.  That combination is taken as often as
its lengths last, so the plan stays about as small as the histogram.  Pieces then look
up their place by their rank among the pieces of equal length; ranks are
counted in salted parts of a length, so that no length gathers in one task.

Defined results: a null text is an empty one, which is the end token alone;
repeated rows are packed each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estatelake.llm.shared import cut_lineage, give_back, tuples
from estatelake.session import ship_package

SIZE = 2048
END = 0  # the id that ends a document
SALT_ROWS = 5_000
PLAIN = 0x250  # below it both tokenizer libraries class characters alike (tested one by one)
RUN = 4_000  # longer unbroken runs go to the library that merges them in n log n


def byte_level(spec: dict) -> bool:
    """Whether a tokenizer file does nothing but cut by ``PATTERN`` and merge bytes in the order of their ids."""
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    plain_cut = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
    extras = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
    if not plain_cut or spec.get("normalizer") or spec.get("truncation") or spec.get("padding"):
        return False
    if model.get("type") != "BPE" or any(model.get(x) for x in extras):
        return False
    vocabulary = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [vocabulary["".join(pair)] for pair in pairs]
    special = {t["content"] for t in spec["added_tokens"]}
    single = sum(len(token) == 1 for token in vocabulary if token not in special)
    # Every token is a byte or the result of one merge.
    return made == sorted(set(made)) and single == 256 and len(vocabulary.keys() - special) == 256 + len(made)


@lru_cache(maxsize=2)
def encoder(path: str):
    """A function from text to the ids that the tokenizer file at ``path`` gives, as an array.

    Most texts are encoded by tiktoken over the same vocabulary, which gives the same
    ids several times faster; texts with characters or runs that it may treat
    differently are encoded by tokenizers itself, and so are all texts if the file is
    not a plain ``byte_level`` one.
    """
    import tiktoken
    from tokenizers import Tokenizer

    exact: list[Tokenizer] = []  # loaded when first needed
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if not byte_level(spec):
        whole = Tokenizer.from_file(path)
        return lambda text: np.array(whole.encode(text, add_special_tokens=False).ids, np.uint32)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    # Byte-level vocabularies write printable bytes as themselves and the others, in order, from U+0100 on.
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    letters = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    vocabulary = spec["model"]["vocab"]
    ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items() if token not in special}
    fast = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    long_run = re.compile(rf"\S{{{RUN}}}|\s{{{RUN}}}")

    def encode(text: str) -> np.ndarray:
        plain = text.isascii() or ord(max(text)) < PLAIN
        if plain and not (len(text) > RUN and long_run.search(text)) and not any(s in text for s in special):
            return fast.encode_to_numpy(text, disallowed_special=()).astype(np.uint32)
        if not exact:
            exact.append(Tokenizer.from_file(path))
        return np.array(exact[0].encode(text, add_special_tokens=False).ids, np.uint32)

    return encode


# Fixed value: how the byte-level tokenizers cut a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pieces(docs: DataFrame, tokenizer: str | None = None, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc, piece, start, length, crc`` of every document's pieces; of a cut one the first is the short one.

    ``tokenizer`` is the path of a tokenizer file that every executor can open
    (by default the installed public one).
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer or default_tokenizer())
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in tuples(batch):
                ids = np.append(encode(text) if text else np.zeros(0, np.uint32), np.uint32(END)).astype("<u4")
                edges = [0, *range(len(ids) % size or size, len(ids) + 1, size)] if len(ids) > size else [0, len(ids)]
                rows += [(doc, i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc", "piece", "start", "length", "crc"])
        give_back()

    ship_package(docs.sparkSession)
    pairs = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    return pairs.mapInArrow(cut, "doc long, piece int, start long, length long, crc long")


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length make the fullest combination that fits into ``room``."""
    if room <= 0:
        return {}
    reach, steps, within = 1, [], (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if 0 < x <= room and counts[x] > 0), reverse=True):
        take, left = 1, min(counts[length], room // length)
        while left > 0:  # a count as a sum of powers of two and a rest
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & within
            left -= take
            take *= 2
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + take
            total -= length * take
    return used


def plan_bins(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, dict[int, int]]]:
    """``(bins, {length: pieces in each})``, largest lengths first; every piece of the histogram is used once."""
    left, plan = {x: n for x, n in histogram.items() if n > 0}, []
    while left:
        longest = max(left)
        left[longest] -= 1
        combination = fullest(left, size - longest)
        left[longest] += 1
        combination[longest] = combination.get(longest, 0) + 1
        bins = min(left[x] // n for x, n in combination.items())
        plan.append((bins, combination))
        for x, n in combination.items():
            left[x] -= bins * n
            if not left[x]:
                del left[x]
    return plan


def places(plan: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Rows ``length, first rank, pieces per bin, first sequence, offset``, sorted by the first two."""
    rows, ranks, sequence = [], {}, 0
    for bins, combination in plan:
        offset = 0
        for length, n in sorted(combination.items(), reverse=True):
            rows.append((length, ranks.get(length, 0), n, sequence, offset))
            ranks[length] = ranks.get(length, 0) + bins * n
            offset += length * n
        sequence += bins
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def salted(cut: DataFrame, histogram: dict[int, int], size: int) -> DataFrame:
    """Written pieces with a ``salt``, by which each length is ranked in parts of about ``SALT_ROWS`` rows.

    Equal rows differ by their place in what was written, so they are dealt over the parts too.
    """
    parts = F.lit([max(1, -(-histogram.get(length, 0) // SALT_ROWS)) for length in range(size + 1)])
    place = F.monotonically_increasing_id()
    return cut.withColumn("salt", F.pmod(F.xxhash64("doc", "piece", "crc", place), F.get(parts, F.col("length").cast("int"))))


def pack(docs: DataFrame, tokenizer: str | None = None, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece with its sequence and its offset there."""
    cut = cut_lineage(pieces(docs, tokenizer, size, id_col, text_col))
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # `size` rows at most
    table = places(plan_bins(histogram, size))
    dealt = salted(cut, histogram, size)
    part = Window.partitionBy("length", "salt")
    ranked = dealt.withColumn("rank", F.row_number().over(part.orderBy("doc", "piece", "start", "crc")) - 1)
    sizes = dealt.groupBy("length", "salt").count()
    before = F.sum("count").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    firsts = sizes.select("length", "salt", F.coalesce(before, F.lit(0)).alias("first"))
    ranked = ranked.join(firsts, ["length", "salt"]).select(
        "doc", "piece", "start", "length", "crc", (F.col("first") + F.col("rank")).alias("rank")
    )

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, firsts_ = table[:, 0], table[:, 1]
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            # The last row of the same length whose first rank is not beyond this one.
            row = np.searchsorted((lengths << 40) + firsts_, (length << 40) + rank, side="right") - 1
            nth = rank - firsts_[row]
            sequence, offset = table[row, 3] + nth // table[row, 2], table[row, 4] + nth % table[row, 2] * length
            yield pa.record_batch([*batch.columns[:5], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:5], "sequence", "offset"])

    return ranked.mapInArrow(placed, "doc long, piece int, start long, length long, crc long, sequence long, offset long")
