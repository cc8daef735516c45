"""Sharding by a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a prime-sized table
(an offset and a stride taken from the hash of its name); shards take turns claiming
their next free slot until the table is full.  So every shard has the same share to
within one slot, and a shard that joins or leaves moves few other slots.  The table is
broadcast (``size`` rows, fixed), and a row is placed by one lookup of its key's slot.
Placement depends on the key alone, so a hot source or a copy of a text does not
crowd a shard.

Defined results: a null key is placed like an empty one; repeated rows go to the
same shard; other columns are ignored; an empty list of shards is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARDS = tuple(f"shard-{i:02d}" for i in range(32))
SIZE = 4099  # a prime, over 100 slots for each shard


def preferences(shard: str, size: int) -> tuple[int, int]:
    """Offset and stride of a shard's order of preference."""
    digest = hashlib.md5(shard.encode()).digest()
    return int.from_bytes(digest[:8], "big") % size, int.from_bytes(digest[8:], "big") % (size - 1) + 1


def fill(shards: Sequence[str], size: int = SIZE) -> list[int]:
    """The table: for each slot, the index of the shard that claimed it."""
    if not shards or len(set(shards)) != len(shards) or len(shards) > size:
        raise ValueError("shards must be distinct names, one at least and no more than the table has slots")
    if size < 2 or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError(f"the table size must be a prime, not {size}")
    at, stride = map(list, zip(*(preferences(s, size) for s in shards), strict=True))
    table, free, turn = [-1] * size, size, 0
    while free:
        while table[at[turn]] >= 0:
            at[turn] = (at[turn] + stride[turn]) % size
        table[at[turn]], free = turn, free - 1
        turn = (turn + 1) % len(shards)
    return table


def slot(key: Column, size: int = SIZE) -> Column:
    """The slot of a key: 60 bits of its text's MD5, modulo the table size."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long"), F.lit(size)).cast("int")


def place(df: DataFrame, key: str, shards: Sequence[str] = SHARDS, size: int = SIZE) -> DataFrame:
    """``key, slot, shard`` for every row."""
    rows = [(i, shards[s]) for i, s in enumerate(fill(shards, size))]
    table = df.sparkSession.createDataFrame(rows, "slot int, shard string")
    keyed = df.select(F.col(key).alias("key"), slot(F.col(key), size).alias("slot"))
    return keyed.join(F.broadcast(table), "slot").select("key", "slot", "shard")
