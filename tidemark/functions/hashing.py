"""String hashing and Bloom filter positions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_32 = 1 << 32
_TWO_31 = 1 << 31


def java_hash(s: Column) -> Column:
    """`String.hashCode` as bigint, taken over the UTF-16 units of the text."""
    units = F.regexp_extract_all(F.hex(F.encode(s, "UTF-16BE")), F.lit("(.{4})"), F.lit(1))
    return F.aggregate(
        units,
        F.lit(0).cast("bigint"),
        lambda acc, unit: (acc * 31 + F.conv(unit, 16, 10).cast("bigint")) % _TWO_32,
        lambda acc: F.when(acc >= _TWO_31, acc - _TWO_32).otherwise(acc),
    )


def bloom_bits(tag: Column, m: int = 100, k: int = 3, family: str = "mod") -> Column:
    """Bit positions of a tag in a filter of `m` bits.

    "mod" is the fixed family of three remainders, for m = 100. "xxhash" derives any
    number of positions from two 64-bit hashes.
    """
    if family == "mod":
        if (m, k) != (100, 3):
            raise ValueError("the mod family has 100 bits and 3 hashes")
        h = java_hash(tag)
        # The remainders of the three hash functions.
        return F.array(
            F.abs(h % 100),
            F.abs(h % 50) + F.abs(h % 51),
            F.abs(h % 25) + F.abs(h % 76),
        ).cast("array<bigint>")
    if family != "xxhash":
        raise ValueError(f"unknown hash family: {family}")
    start = F.pmod(F.xxhash64(tag), F.lit(m))
    step = F.pmod(F.xxhash64(tag, F.lit(1)), F.lit(m))
    return F.array(*[(start + step * i) % m for i in range(k)]).cast("array<bigint>")


def bloom_sizing(n: Column, m: int | Column, k: Column | int | None = None) -> tuple[Column, Column]:
    """(number of hashes, expected false-positive rate) for `n` keys in `m` bits."""
    bits = m if isinstance(m, Column) else F.lit(m)
    per_key = bits.cast("double") / n
    hashes = F.ceil(per_key * F.log(F.lit(2.0))) if k is None else (k if isinstance(k, Column) else F.lit(k))
    rate = F.pow(1 - F.exp(-hashes / per_key), hashes)
    return hashes.cast("int"), rate
