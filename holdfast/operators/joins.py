"""Joins that hold when a side grows or one key dominates.

Row-level joins here always meet a side with unique keys, so a hot key on the other
side is split at run time by adaptive skew handling; what can be counted per key is
counted before it travels.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.session import SMALL_ROWS, cut_measured, fits_broadcast


def null_safe_join(left: DataFrame, right: DataFrame, names: list[str],
                   how: str = "inner") -> DataFrame:
    """Equi-join on natural keys where NULL equals NULL; the key comes from the left."""
    renamed = right.withColumnsRenamed({n: f"_right_{n}" for n in names})
    same = reduce(lambda a, b: a & b,
                  [F.col(n).eqNullSafe(F.col(f"_right_{n}")) for n in names])
    return left.join(renamed, same, how).drop(*[f"_right_{n}" for n in names])


def join_small(big: DataFrame, small: DataFrame, names: list[str], how: str = "inner",
               max_rows: int = SMALL_ROWS) -> DataFrame:
    """Null-safe join to a side with unique keys that is expected to be small.

    The small side is fixed once; it is broadcast only when its rows and bytes prove
    that it fits, and shuffled like any other table when it does not.
    """
    fixed, few = cut_measured(small)
    if max_rows and few and (max_rows >= SMALL_ROWS or fits_broadcast(fixed, max_rows)):
        fixed = F.broadcast(fixed)
    return null_safe_join(big, fixed, names, how)


def orphan_count(child: DataFrame, parent: DataFrame, key: str, name: str = "orphans") -> DataFrame:
    """Rows of ``child`` whose key is absent from ``parent``; a NULL key is an orphan.

    Child rows are counted per key first, so a hot key travels as one row.
    """
    sizes = child.groupBy(key).agg(F.count("*").alias("_n"))
    return (sizes.join(parent.select(key), key, "left_anti")
            .agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias(name)))


def matched_rows(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of ``child`` whose key exists in ``parent``."""
    return child.join(parent.select(key), key, "left_semi")
