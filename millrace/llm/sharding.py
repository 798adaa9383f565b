"""Consistent placement by a permutation-filled lookup table. DataFrame functions only."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name

# Slots of the table, a prime over a hundred times the usual number of shards. It bounds what is broadcast.
SLOTS = 4099
# Hexadecimal digits of a digest that make a number.
DIGITS = 15


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:DIGITS], 16)


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def fill_table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """The shard number of each slot.

    A shard prefers the slots start, start + step, start + 2 step ... modulo the prime
    number of slots. Shards take turns and claim the first free slot they prefer, so
    each has floor or ceil of slots / shards, and a shard that leaves moves few others.
    """
    names = list(shards)
    if not names or len(set(names)) < len(names):
        raise ValueError("shards need distinct names, one at least")
    if not _is_prime(slots) or slots < len(names):
        raise ValueError("slots must be a prime, not below the number of shards")
    place = [_number(f"start:{n}") % slots for n in names]
    step = [_number(f"step:{n}") % (slots - 1) + 1 for n in names]
    table = [-1] * slots
    for turn in range(slots):
        shard = turn % len(names)
        while table[place[shard]] >= 0:
            place[shard] = (place[shard] + step[shard]) % slots
        table[place[shard]] = shard
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key: MD5 of its text, the leading digits as a number, modulo ``slots``."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("long"), F.lit(slots))


def shard_rows(df: DataFrame, key: str, shards: Sequence[str], slots: int = SLOTS,
               without: Sequence[str] = ()) -> DataFrame:
    """``df`` with slot long, shard string and, given ``without``, shard_after string.

    ``shard_after`` is the place once the shards named in ``without`` have left. The table has
    ``slots`` rows whatever the data, so it is broadcast; no row moves. A hot key is no
    burden as placement groups nothing.

    A null key is placed as the empty text. Equal keys share a shard. An empty table gives no
    rows. Columns of ``df`` named as the new ones are replaced.
    """
    names = list(shards)
    before = fill_table(names, slots)
    left = [n for n in names if n not in set(without)]
    after = fill_table(left, slots) if without else None
    rows = [(i, names[s], left[after[i]] if after else None) for i, s in enumerate(before)]
    added = ["shard", "shard_after"] if without else ["shard"]
    at = free_name("__slot", *df.columns)
    table = df.sparkSession.createDataFrame(rows, f"{at} long, shard string, shard_after string")
    kept = [c for c in df.columns if c not in ("slot", *added)]
    placed = df.select(*[F.col(f"`{c}`") for c in kept], slot_of(F.col(f"`{key}`"), slots).alias("slot"))
    return (placed.join(F.broadcast(table.select(at, *added)), F.col("slot") == F.col(at))
            .select(*[F.col(f"`{c}`") for c in kept], "slot", *added))
