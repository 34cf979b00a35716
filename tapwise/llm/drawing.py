"""Samples drawn by hash, with shares that hold at any size."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAW = 1 << 62


def share(n: int, wanted: int) -> int:
    """Of DRAW, the part that draws about `wanted` of `n` rows; never nothing, and everything if there are no more."""
    return DRAW if n <= wanted else max(1, DRAW * wanted // n)


def drawn_number(name: str, *keys: str) -> Column:
    """A number below DRAW by a hash of `keys`, another one for each `name`."""
    return F.pmod(F.xxhash64(F.lit(name), *keys), F.lit(DRAW))
