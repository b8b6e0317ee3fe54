"""Distinct counts from stored sketches.

A sketch of a day is a few kilobytes and can be kept. Those of a month, a region or all
time come from merging them, without a look at the rows again; theta sketches can also be
intersected. HyperLogLog of ``2**k`` registers has a relative standard error of
1.04 / sqrt(2**k), theta of ``2**k`` hashes one of 1 / sqrt(2**k); :func:`bound` gives
the error that four of them allow. Hashing is fixed, so the same rows give the same
estimate in whatever order they come.
"""

from __future__ import annotations

from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.functions.columns import as_list

K = 12  # 4,096 registers or hashes


def distinct_sketches(df: DataFrame, by, value: str, name: str = "sketch", k: int = K, kind: str = "hll") -> DataFrame:
    """One sketch of ``value`` for each group: the table to keep, at the finest grain."""
    make = F.hll_sketch_agg(value, k) if kind == "hll" else F.theta_sketch_agg(value, k)
    return df.groupBy(*as_list(by)).agg(make.alias(name))


def roll_up(sketches: DataFrame, by, name: str = "sketch", k: int = K, kind: str = "hll") -> DataFrame:
    """Sketches of coarser groups from those of finer ones."""
    merge = F.hll_union_agg(name) if kind == "hll" else F.theta_union_agg(name, k)
    return sketches.groupBy(*as_list(by)).agg(merge.alias(name))


def estimate(sketch, kind: str = "hll") -> Column:
    return (F.hll_sketch_estimate(sketch) if kind == "hll" else F.theta_sketch_estimate(sketch)).cast("long")


def in_both(a, b) -> Column:
    """Estimated number of values that two theta sketches share. Its error is relative to
    their union, so compare it with ``bound(union)``."""
    return F.theta_sketch_estimate(F.theta_intersection(a, b)).cast("long")


def bound(exact, k: int = K, kind: str = "hll") -> Column:
    """How far an estimate may be off: four standard errors."""
    return F.ceil(exact * F.lit(4 * (1.04 if kind == "hll" else 1.0) / sqrt(2**k)))
