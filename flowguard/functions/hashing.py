"""Deterministic per-row randomness from a seed and a row key.

All sampling in flowguard orders rows by ``md5(seed | salt | key...)``: the
result depends only on the data, never on partitioning or task order, and the
same expression is available in plain SQL engines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKET_HEX_CHARS = 4  # 65,536 hash buckets per group


def _parts(seed: int, salt: str, keys: Sequence[Column | str]) -> list[Column]:
    cols = [F.lit(str(seed)), F.lit(salt)]
    cols += [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    return cols


def order_hash(seed: int, salt: str, keys: Sequence[Column | str]) -> Column:
    """Hex md5 of ``seed|salt|key1|key2...``; string order = hash order."""
    return F.md5(F.concat_ws("|", *_parts(seed, salt, keys)))


def hash_bucket(h: Column, hex_chars: int = BUCKET_HEX_CHARS) -> Column:
    """Leading ``hex_chars`` of a hex hash as an int; monotone in hash order."""
    return F.conv(F.substring(h, 1, hex_chars), 16, 10).cast("int")


def uniform01(seed: int, salt: str, keys: Sequence[Column | str]) -> Column:
    """A number in [0, 1) from the first 32 bits of the md5 of the parts."""
    h = order_hash(seed, salt, keys)
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def hash_long(seed: int, salt: str, keys: Sequence[Column | str]) -> Column:
    """First 60 bits of the md5 as a non-negative bigint (for modulo picks)."""
    h = order_hash(seed, salt, keys)
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint")
