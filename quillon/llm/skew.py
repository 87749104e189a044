"""Lookups by keys of which a few may hold most rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with at least one row in so many of all is looked up by broadcast; there are at most so many such keys.
SHARE = 2000


def lookup(left: DataFrame, right: DataFrame, keys: dict[str, str], uses: str, total: int, share: int | None = None) -> DataFrame:
    """Rows of ``left`` with the one row of ``right`` that has their keys ({column of left: column of right}, null equal to null); rows without one are dropped.

    ``uses`` of ``right`` says how many rows of ``left`` look for that key, ``total`` is their sum. Keys with a ``share``-th of it
    (``SHARE``) or more are at most so many, so they are broadcast; any other key has less than that share of the rows in one task.
    """

    share = share or SHARE

    def same(a: DataFrame, b: DataFrame):
        return reduce(lambda x, y: x & y, (a[k].eqNullSafe(b[v]) for k, v in keys.items()))

    drop = [v for v in dict.fromkeys([*keys.values(), uses]) if v not in left.columns]
    both = set(left.columns) & set(right.columns)
    assert not both, f"columns of both sides: {sorted(both)}"
    heavy = right.where(F.col(uses) * share >= total)
    light = right.where(F.col(uses) * share < total)
    often = left.join(F.broadcast(heavy), same(left, heavy))
    seldom = left.join(F.broadcast(heavy.select(*keys.values())), same(left, heavy), "left_anti")
    return often.unionByName(seldom.join(light, same(seldom, light))).drop(*drop)
