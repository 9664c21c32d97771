"""Global order without an unbounded single-task window.

``Window.orderBy`` with no partition moves every row to one task, which is fine only
for a proven small number of rows. Beyond that the rows are range-sorted across
tasks, fixed by a reliable checkpoint, and one small row per slice carries the running
offsets. Order by enough columns to make the order total: a value that holds a third
of the rows is then spread over many slices by the tie-break columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast.functions.columns import col
from holdfast.operators.joins import join_small
from holdfast.session import SMALL_ROWS, cut, cut_counted

_SLICE_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits
SLICE_ROWS = 200_000  # rows a slice is meant to hold
FEW_SLICES = 8


def _slices(df: DataFrame, rows: int) -> int:
    """Slices for so many rows. The driver samples 300 whole sort keys for each slice to find the boundaries, so slices
    follow the rows and not the shuffle partitions, which may be many more."""
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(most, max(FEW_SLICES, -(-rows // SLICE_ROWS)))


def _sliced(df: DataFrame, order: list[Column | str], rows: int = 0) -> DataFrame:
    """Range-sorted rows with a slice number that follows the order, and the position inside it. ``rows`` is the row
    count of ``df``."""
    keys = [col(c) for c in order]
    placed = df.repartitionByRange(_slices(df, rows), *keys).sortWithinPartitions(*keys).withColumn(
        "_place", F.monotonically_increasing_id())
    return cut(placed.select(
        *df.columns,
        F.shiftright("_place", _SLICE_BITS).alias("_slice"),
        F.col("_place").bitwiseAND((1 << _SLICE_BITS) - 1).alias("_pos")))


def _offsets(slices: DataFrame, totals: list[str]) -> DataFrame:
    """Running totals before each slice. One row per slice, so a plain window is enough."""
    ordered = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    return slices.select(
        "_slice",
        *[F.coalesce(F.sum(t).over(ordered), F.lit(0)).alias(f"_before{t}") for t in totals],
        *[F.sum(t).over(W.partitionBy()).alias(f"_all{t}") for t in totals])


def global_rank(df: DataFrame, order: list[Column | str], rank: str = "global_rank",
                total: str | None = None, small_rows: int = SMALL_ROWS) -> DataFrame:
    """Add 1..n in the given total order, and optionally n itself."""
    fixed, rows = cut_counted(df)
    extra = [F.lit(rows).cast("bigint").alias(total)] if total else []
    if rows <= small_rows:
        w = W.orderBy(*[col(c) for c in order])
        return fixed.select("*", F.row_number().over(w).cast("bigint").alias(rank), *extra)
    laid = _sliced(fixed, order, rows)
    slices = laid.groupBy("_slice").agg(F.count("*").alias("_n"))
    return laid.join(F.broadcast(_offsets(slices, ["_n"])), "_slice").select(
        *df.columns, (F.col("_before_n") + F.col("_pos") + 1).alias(rank), *extra)


def running_totals(df: DataFrame, order: list[Column | str], totals: dict[str, str],
                   small_rows: int = SMALL_ROWS, rows: int | None = None) -> DataFrame:
    """Add ``totals[c]`` = sum of column ``c`` over all rows up to and including this one. ``rows`` is the row count
    of a ``df`` that is stored already."""
    fixed, rows = cut_counted(df) if rows is None else (df, rows)
    if rows <= small_rows:
        w = W.orderBy(*[col(c) for c in order]).rowsBetween(W.unboundedPreceding, 0)
        return fixed.select("*", *[F.sum(c).over(w).alias(t) for c, t in totals.items()])
    return _sliced_totals(fixed, order, totals, rows)


def _sliced_totals(fixed: DataFrame, order: list[Column | str],
                   totals: dict[str, str], rows: int) -> DataFrame:
    laid = _sliced(fixed, order, rows)
    local = W.partitionBy("_slice").orderBy("_pos").rowsBetween(W.unboundedPreceding, 0)
    slices = laid.groupBy("_slice").agg(*[F.sum(c).alias(f"_{c}") for c in totals])
    offsets = _offsets(slices, [f"_{c}" for c in totals])
    return (laid.select("*", *[F.sum(c).over(local).alias(f"_local_{c}") for c in totals])
            .join(F.broadcast(offsets), "_slice")
            .select(*fixed.columns, *[(F.col(f"_before_{c}") + F.col(f"_local_{c}")).alias(name)
                                      for c, name in totals.items()]))


def ntile_of(rank: Column, n: Column, tiles: int) -> Column:
    """SQL NTILE as arithmetic on the global rank: the first n mod k tiles get one row more."""
    size, longer = F.floor(n / tiles), n % tiles
    head = longer * (size + 1)
    return F.when(rank <= head, F.floor((rank - 1) / (size + 1)) + 1).otherwise(
        longer + F.floor((rank - 1 - head) / F.greatest(size, F.lit(1))) + 1).cast("int")


def position_tile_of(rank: Column, n: Column, tiles: int) -> Column:
    """Tile by position, floor(i*k/n)+1 for i = 0..n-1. Differs from NTILE when k does not divide n."""
    return (F.floor((rank - 1) * tiles / n) + 1).cast("int")


def ntile(df: DataFrame, order: list[Column | str], tiles: int, name: str) -> DataFrame:
    ranked = global_rank(df, order, "_rank", "_total")
    return ranked.withColumn(name, ntile_of(F.col("_rank"), F.col("_total"), tiles)).drop(
        "_rank", "_total")


def position_tiles(df: DataFrame, order: list[Column | str], tiles: int, name: str) -> DataFrame:
    ranked = global_rank(df, order, "_rank", "_total")
    return ranked.withColumn(name, position_tile_of(F.col("_rank"), F.col("_total"), tiles)).drop(
        "_rank", "_total")


def average_rank(df: DataFrame, value: str, name: str) -> DataFrame:
    """One row per distinct value with its tie-averaged rank and row count.

    Equal values share a rank, so ranking the value histogram is enough; the rows
    themselves never need sorting.
    """
    hist = df.groupBy(value).agg(F.count("*").alias("rows"))
    run = running_totals(hist, [value], {"rows": "_upto"})
    return run.select(value, "rows",
                      (F.col("_upto") - F.col("rows") + (F.col("rows") + 1) / 2).alias(name))


def exact_quantiles(df: DataFrame, value: str, probs: dict[str, float],
                    by: list[str] | None = None, small_rows: int = SMALL_ROWS) -> DataFrame:
    """Exact linear-interpolated quantiles, one row per group, without one task per group and without a sort.

    Rows of proven small number go to the built-in ``percentile``. Of more, mergeable sketches per group give a
    bracket for each quantile, at the sketch's error beside it. One scan counts the rows below the brackets and the
    values inside them; these are few, and the neighbours of each quantile are picked from their running counts.
    """
    by = by or []
    fixed, rows = cut_counted(df.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("_v")))
    if rows <= small_rows:
        return fixed.groupBy(*by).agg(*[F.percentile("_v", p).alias(name) for name, p in probs.items()])
    accuracy = int(min(1_000_000, max(10_000, rows ** 0.5)))  # then about 8 * sqrt(rows) values are inside
    slack = 2
    while True:
        picked = cut(_neighbours(fixed, list(probs.values()), by, accuracy, min(1.0, slack / accuracy)))
        if slack >= accuracy or picked.where("_lo is null or _hi is null").isEmpty():
            break
        slack *= 64  # a bracket missed its quantile: wider ones, at last the whole range

    at, lo, hi = F.col("_at"), F.col("_lo"), F.col("_hi")
    between = F.when(lo == hi, lo).otherwise((F.ceil(at) - at) * lo + (at - F.floor(at)) * hi).cast("double")
    return picked.groupBy(*by).agg(*[F.max(F.when(F.col("_k") == k, between)).alias(name)
                                     for k, name in enumerate(probs)])


def _neighbours(fixed: DataFrame, probs: list[float], by: list[str], accuracy: int, slack: float) -> DataFrame:
    """``by, _k, _at, _lo, _hi``: place of the k-th quantile (from 0) and the values on both sides of it; NULL where the
    bracket did not hold them."""
    sides = [min(1.0, max(0.0, p + d)) for p in probs for d in (-slack, slack)]
    group = fixed.groupBy(*by).agg(
        F.count("*").alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"),
        F.percentile_approx("_v", sides, accuracy).alias("_sides"))
    brackets = group.select(*by, F.array(*[
        F.struct(F.lit(k).alias("k"), ((F.col("_n") - 1) * p).alias("at"),
                 (F.col("_min") if sides[2 * k] == 0 else F.get("_sides", F.lit(2 * k))).alias("lo"),
                 (F.col("_max") if sides[2 * k + 1] == 1 else F.get("_sides", F.lit(2 * k + 1))).alias("hi"))
        for k, p in enumerate(probs)]).alias("_brackets"))
    if by:
        met = join_small(fixed, brackets, by)
    else:
        met = fixed.withColumn("_brackets", brackets.scalar())
    one = met.select(*by, "_v", F.explode(F.filter("_brackets", lambda b: F.col("_v") <= b["hi"])).alias("b"))
    # rows below a bracket are one NULL value that sorts first
    inside = F.when(F.col("_v") >= F.col("b.lo"), F.col("_v")).alias("_v")
    hist = one.groupBy(*by, F.col("b.k").alias("_k"), F.col("b.at").alias("_at"), inside).agg(F.count("*").alias("_rows"))
    upto = F.sum("_rows").over(W.partitionBy(*by, "_k").orderBy(F.asc_nulls_first("_v"))
                               .rowsBetween(W.unboundedPreceding, 0))
    run = hist.withColumn("_upto", upto)

    def value(at: Column) -> Column:
        return F.max(F.when((F.col("_upto") - F.col("_rows") <= at) & (at < F.col("_upto")), F.col("_v")))

    return run.groupBy(*by, "_k", "_at").agg(value(F.floor("_at")).alias("_lo"), value(F.ceil("_at")).alias("_hi"))
