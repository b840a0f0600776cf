"""Draws that depend only on (seed, purpose, key), never on partitioning.

Every random choice of the library is an md5 digest of a seed, a purpose word and
the key of the row.  The same row gets the same draw under any number of
partitions, after a task retry, and in any engine that has md5.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_CHARS = "0123456789abcdef"


def draw_hex(seed: int, purpose: str, *keys: Column) -> Column:
    """32 hex digits of md5('seed-purpose-key1-key2...')."""
    parts = [F.lit(str(seed)), F.lit(purpose), *[k.cast("string") for k in keys]]
    return F.md5(F.concat_ws("-", *parts))


def hex_to_long(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("long")


def draw_int(seed: int, purpose: str, *keys: Column) -> Column:
    """Uniform integer in [0, 2^32)."""
    return hex_to_long(F.substring(draw_hex(seed, purpose, *keys), 1, 8))


def draw_unit(seed: int, purpose: str, *keys: Column) -> Column:
    """Uniform double in [0, 1)."""
    return draw_int(seed, purpose, *keys) / F.lit(4294967296.0)
