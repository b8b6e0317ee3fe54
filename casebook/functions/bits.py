"""Small sets of small numbers as the bits of a long, and how often each occurs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from casebook.functions.columns import as_column

MAX_BIT = 62


def bit_set(arr) -> Column:
    """The members of an array of numbers 0 to 62 as bits; a null array has none, other
    numbers are left out."""
    none = F.lit(0).cast("long")

    def add(bits, x):
        fits = x.between(0, MAX_BIT)  # a null is not
        return F.when(fits, bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.coalesce(x, F.lit(0)).cast("int")))).otherwise(bits)

    return F.coalesce(F.aggregate(as_column(arr), none, add), none)


def without(bits: Column, removed: Column) -> Column:
    """Set difference (EXCEPT)."""
    return bits.bitwiseAND(F.bitwise_not(removed))


def has(bits: Column, member: int) -> Column:
    """1 if ``member`` is in the set, else 0."""
    return F.getbit(bits, F.lit(member)).cast("long")


def times_in(arr: Column, member: int) -> Column:
    """How often ``member`` is listed in an array."""
    return F.size(F.filter(arr, lambda x: x == member))


def count_vector(bits: Column, extra, members: Iterable[int]) -> dict[int, Column]:
    """Per member how often it is used: once if in the set, and each time it is in ``extra``."""
    listed = F.coalesce(as_column(extra), F.array().cast("array<int>"))
    return {m: has(bits, m) + times_in(listed, m) for m in members}
