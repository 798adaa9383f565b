"""Hashes and codes whose exact values matter, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 32-bit FNV-1a, the positive mask, the shard count and the
# largest four-letter code.
FNV_OFFSET = 2166136261
FNV_PRIME = 16777619
MASK_32 = 0xFFFFFFFF
MASK_31 = 0x7FFFFFFF
SHARDS = 10
LAST_PREFIX = "zzzz"


def _byte(data: Column, position: Column) -> Column:
    return F.conv(F.hex(F.substring(data, position, F.lit(1))), 16, 10).cast("long")


def fnv1a32(text: Column) -> Column:
    """FNV-1a over the UTF-8 bytes, as an unsigned value in a long."""
    data = text.cast("binary")
    size = F.octet_length(data)
    folded = F.aggregate(
        F.sequence(F.lit(1), F.greatest(size, F.lit(1))),
        F.lit(FNV_OFFSET).cast("long"),
        lambda acc, i: (acc.bitwiseXOR(_byte(data, i)) * F.lit(FNV_PRIME)).bitwiseAND(
            F.lit(MASK_32).cast("long")
        ),
    )
    return F.when(size == 0, F.lit(FNV_OFFSET).cast("long")).otherwise(folded)


def positive_hash(text: Column) -> Column:
    """The 31-bit form used to choose a reduce bucket."""
    return fnv1a32(text).bitwiseAND(F.lit(MASK_31).cast("long"))


def hash_bucket(text: Column, buckets: int) -> Column:
    return (positive_hash(text) % F.lit(buckets)).cast("int")


def shard_bucket(key: Column, shards: int = SHARDS) -> Column:
    """First byte modulo the shard count; the empty key goes to shard 0."""
    data = key.cast("binary")
    first = F.coalesce(_byte(data, F.lit(1)), F.lit(0))
    return F.when(F.octet_length(data) == 0, F.lit(0)).otherwise(first % F.lit(shards)).cast("int")


def prefix_code_of(text: str) -> int:
    """The packed code of a Python constant, before clamping."""
    return sum(ord(ch) << (24 - 8 * i) for i, ch in enumerate(text[:4]))


PREFIX_MAX = prefix_code_of(LAST_PREFIX)


def str_prefix_code(text: Column) -> Column:
    """First four characters packed into a signed 32-bit int, kept within ["", "zzzz"].

    Packing wraps at 32 bits, so a first character past 127 turns negative
    and is raised to the lowest code.
    """
    packed = sum(
        (
            F.when(F.length(text) > i, F.ascii(F.substring(text, i + 1, 1)).cast("long"))
            .otherwise(F.lit(0).cast("long"))
            * F.lit(1 << (24 - 8 * i))
            for i in range(4)
        ),
        F.lit(0).cast("long"),
    )
    low = packed.bitwiseAND(F.lit(MASK_32).cast("long"))
    signed = F.when(low > MASK_31, low - F.lit(MASK_32 + 1)).otherwise(low)
    return F.least(F.greatest(signed, F.lit(0)), F.lit(PREFIX_MAX)).cast("int")


def ordered_code(text: Column) -> Column:
    """First seven bytes as a long: a <= b implies code(a) <= code(b)."""
    head = F.hex(F.substring(text.cast("binary"), 1, 7))
    return F.conv(F.rpad(head, 14, "0"), 16, 10).cast("long")
