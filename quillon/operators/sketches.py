"""Summaries by group that are kept and put together later: counts, distinct values (HyperLogLog) and quantiles (KLL), all by Spark's own aggregates.

``summarise`` reads the table once; one row a group is what is stored, some KB a column. ``combined`` makes any coarser grouping of stored rows from them, and so for any
range of years or kinds without the table. Nulls aren't counted as values; a group without values has null estimates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the registers' number: the relative standard error is 1.04 / 2**(bits / 2); and the size of a quantile sketch: its rank error is below 1.33 % at 200.
HLL_BITS, KLL_SIZE = 12, 200
HLL_ERROR, KLL_ERROR = 1.04 / 2 ** (HLL_BITS / 2), 0.0133


def summarise(df: DataFrame, groups: dict[str, Column], distinct: list[str] = (), quantiles: list[str] = ()) -> DataFrame:
    """The groups' columns, n, d_<c> for each column of ``distinct`` and q_<c> for each of ``quantiles`` (numbers)."""
    made = [F.count("*").alias("n"), *(F.hll_sketch_agg(F.col(f"`{c}`").cast("string"), HLL_BITS).alias(f"d_{c}") for c in distinct), *(F.kll_sketch_agg_double(F.col(f"`{c}`").cast("double"), KLL_SIZE).alias(f"q_{c}") for c in quantiles)]
    return df.groupBy(*(c.alias(n) for n, c in groups.items())).agg(*made)


def combined(stored: DataFrame, groups: list[str] = ()) -> DataFrame:
    """Rows of ``summarise`` put together by fewer of its groups, or all of them."""
    made = [F.sum("n").alias("n")]
    made += [(F.hll_union_agg(c) if c.startswith("d_") else F.kll_merge_agg_double(c, KLL_SIZE)).alias(c) for c in stored.columns if c.startswith(("d_", "q_"))]
    return stored.groupBy(*groups).agg(*made)


def distinct_count(column: str) -> Column:
    return F.hll_sketch_estimate(f"d_{column}")


def quantile(column: str, share: float) -> Column:
    return F.kll_sketch_get_quantile_double(f"q_{column}", F.lit(float(share)))
