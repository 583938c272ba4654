"""Column-level expressions (no UDFs): label text, hashing, numeric guards."""

from flowguard.functions.hashing import hash_bucket, order_hash, uniform01
from flowguard.functions.labels import (
    normalize_label, short_day, strip_ws, title_case,
)
from flowguard.functions.numeric import is_infinite, null_if_infinite, null_if_negative

__all__ = [
    "hash_bucket", "order_hash", "uniform01", "normalize_label", "short_day",
    "strip_ws", "title_case", "is_infinite", "null_if_infinite", "null_if_negative",
]
