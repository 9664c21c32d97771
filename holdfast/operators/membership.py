"""Key checks by bit sets: which whole-number keys can be repeated or orphaned, before any row is shuffled.

A key of one or several whole-number columns has a position in the box that the smallest and largest values span (NULL is a
value of its own). Positions are kept as bit sets of 32,768 bits, built in each task and merged per set. A set with as many rows
as bits has no repeated key; one that a parent's set covers has no orphan. Counts of repeated rows follow from the sets alone.
Where keys are asked for, only rows of the sets in doubt are shuffled and compared exactly.

Sets pay when tasks read keys that lie close together, as in files sorted or clustered by key. That is measured first, in one
scan of the key columns that gives one row per task: beyond ``MOST_BYTES`` of sets a row, and for keys that are no whole
numbers, the check groups by key instead. Both ways give the same result.

Empty tables have no repeated and no orphaned keys. A NULL key column equals NULL in repeated keys; a key with a NULL part has
no parent. Columns of the table are read by name only, so that further columns of any name do no harm.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.session import cut_measured

BITS = 32_768  # of one set; the size that the bitmap functions work with
MOST_BYTES = 16  # of sets that may travel for a row; beyond it a row's key travels instead
MOST_POSITIONS = 1 << 62
WHOLE = {"tinyint", "smallint", "int", "bigint"}


@dataclass(frozen=True)
class Box:
    """Smallest value and number of positions of each key column, position 0 being NULL."""

    key: tuple[str, ...]
    low: tuple[int, ...]
    size: tuple[int, ...]

    def position(self) -> Column:
        parts = [F.coalesce(F.col(f"`{c}`").cast("bigint") - F.lit(lo) + 1, F.lit(0))
                 for c, lo in zip(self.key, self.low)]
        return reduce(lambda at, nxt: at * F.lit(nxt[1]) + nxt[0], zip(parts[1:], self.size[1:]), parts[0])


def whole_key(df: DataFrame, key: list[str]) -> bool:
    types = dict(df.dtypes)
    return all(types.get(c) in WHOLE for c in key)


def measure(frames: list[DataFrame], key: list[str]) -> Box | None:
    """The box of the key over all frames, or None where sets would be larger than the keys themselves."""
    if not all(whole_key(df, key) for df in frames):
        return None
    number = [F.col(f"`{c}`").cast("bigint") for c in key]
    tasks = None
    for i, df in enumerate(frames):
        part = df.groupBy(F.spark_partition_id().alias("task")).agg(
            F.count(F.lit(1)).alias("rows"), *[F.min(c).alias(f"lo{j}") for j, c in enumerate(number)],
            *[F.max(c).alias(f"hi{j}") for j, c in enumerate(number)]).withColumn("frame", F.lit(i))
        tasks = part if tasks is None else tasks.unionByName(part)
    span = F.coalesce(F.col("hi0").cast("decimal(38,0)") - F.col("lo0"), F.lit(0)) + 2
    got = tasks.agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("tasks"), F.sum(span).alias("span"),
                    *[F.min(f"lo{j}").alias(f"lo{j}") for j in range(len(key))],
                    *[F.max(f"hi{j}").alias(f"hi{j}") for j in range(len(key))]).first()
    low = tuple(0 if got[f"lo{j}"] is None else got[f"lo{j}"] for j in range(len(key)))
    size = tuple(2 + (0 if got[f"hi{j}"] is None else got[f"hi{j}"] - lo) for j, lo in enumerate(low))
    behind = reduce(lambda a, b: a * b, size[1:], 1)
    if behind * size[0] > MOST_POSITIONS:
        return None
    rows = got["rows"] or 0
    sets = min(rows, int(got["span"] or 0) * behind // BITS + 2 * got["tasks"])
    if rows > BITS and sets * (BITS // 8) > MOST_BYTES * rows:
        return None
    return Box(tuple(key), low, size)


def bit_sets(df: DataFrame, box: Box) -> DataFrame:
    """One row per set: its number, rows and bits. Sets are built in each task, so rows themselves do not travel."""
    return df.select(box.position().alias("_at")).groupBy(F.shiftright("_at", 15).alias("_set")).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.bitmap_construct_agg(F.col("_at").bitwiseAND(F.lit(BITS - 1))).alias("_bits"))


def _of_sets(df: DataFrame, box: Box, sets: DataFrame) -> DataFrame:
    """Rows whose position lies in one of the sets; these are broadcast only if they are proven few."""
    fixed, few = cut_measured(sets.select("_set"))
    numbered = df.withColumn("_set", F.shiftright(box.position(), 15))
    return numbered.join(F.broadcast(fixed) if few else fixed, "_set", "left_semi").drop("_set")


def duplicate_rows(df: DataFrame, key: list[str], name: str = "duplicates") -> DataFrame:
    """Rows beyond the first of each key, as one row."""
    box = measure([df.select(*key)], key)
    if box is None:
        return (df.groupBy(*key).agg((F.count(F.lit(1)) - 1).alias("_extra"))
                .agg(F.coalesce(F.sum("_extra"), F.lit(0)).cast("bigint").alias(name)))
    return bit_sets(df, box).agg(
        F.coalesce(F.sum(F.col("_rows") - F.bitmap_count("_bits")), F.lit(0)).cast("bigint").alias(name))


def repeated_keys(df: DataFrame, key: list[str], name: str = "rows") -> DataFrame:
    """Keys that occur more than once, and how often. Only rows of sets with fewer bits than rows are shuffled."""
    rows = df.select(*key)
    box = measure([rows], key)
    if box is not None:
        rows = _of_sets(rows, box, bit_sets(rows, box).where(F.col("_rows") > F.bitmap_count("_bits")))
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)


def _suspects(child: DataFrame, parent: DataFrame, key: list[str], box: Box) -> DataFrame:
    """Child rows of the sets in which the parent's bits do not cover the child's."""
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
    both = (bit_sets(parent.where(whole), box).select("_set", "_bits", F.lit(True).alias("_known"))
            .unionByName(bit_sets(child, box).select("_set", "_bits", F.lit(False).alias("_known"))))
    sets = both.groupBy("_set").agg(
        F.bitmap_count(F.bitmap_or_agg("_bits")).alias("_all"),
        F.coalesce(F.max(F.when(F.col("_known"), F.bitmap_count("_bits"))), F.lit(0)).alias("_of_parent"))
    return _of_sets(child, box, sets.where("_all > _of_parent"))


def orphan_keys(child: DataFrame, parent: DataFrame, key: list[str], name: str = "rows") -> DataFrame:
    """Keys of ``child`` that ``parent`` lacks, and how many rows have them. Only rows in doubt are shuffled; they are
    counted per key before they meet the parent."""
    rows, known = child.select(*key), parent.select(*key)
    box = measure([rows, known], key)
    if box is not None:
        rows = _suspects(rows, known, key, box)
    counted = rows.groupBy(*key).agg(F.count(F.lit(1)).alias(name))
    return counted.join(known, key, "left_anti")


def orphan_rows(child: DataFrame, parent: DataFrame, key: list[str], name: str = "orphans") -> DataFrame:
    """Rows of ``child`` whose key is absent from ``parent``, as one row; a key with a NULL part is an orphan."""
    return orphan_keys(child, parent, key, "_n").agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias(name))
