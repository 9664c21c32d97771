"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.session import scratch_path

BLANK = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def words_of(text: Column) -> Column:
    """Maximal runs of characters that are no ASCII white space; NULL gives an empty array."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def stored(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back: fixes the rows, cuts the
    lineage and outlives lost executors. ``rows``, if about known, keeps a small table from being written as very
    many files: one for each million, eight at least, dealt anew behind what computes them."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    (df if rows is None else df.repartition(max(8, -(-rows // 1_000_000)))).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_file(path: str, most_bytes: int = 32 << 20) -> bytes:
    """A vocabulary file read on the driver, refused beyond ``most_bytes`` because it is broadcast."""
    size = Path(path).stat().st_size
    if size > most_bytes:
        raise ValueError(f"{path} has {size} bytes; at most {most_bytes} are broadcast")
    return Path(path).read_bytes()


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


_held: list = []  # the cache that this worker process keeps


def hold(cache: dict) -> None:
    """Keep ``cache`` in this worker process and empty the one of another operator, so that a worker that serves
    several operators holds one at a time."""
    if not any(c is cache for c in _held):
        for other in _held:
            other.clear()
        _held[:] = [cache]


def in_parts(sizes: list[int], most: int):
    """Ranges of rows whose sizes add up to about ``most``, or one larger row."""
    start = held = 0
    for i, size in enumerate(sizes):
        held += size
        if held >= most:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this library where it lies at the same path as on the driver. Elsewhere
    it has to be installed or sent with ``--py-files``."""
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [root])


def map_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this library on the workers' path."""
    on_workers(df.sparkSession)
    return df.mapInArrow(function, schema)


def semi(df: DataFrame, ids: DataFrame, key: str, how: str = "left_semi",
         most_rows: int = 1_000_000) -> DataFrame:
    """``df`` with (or without, ``left_anti``) the keys in ``ids``, a stored table of one integer column.

    Up to ``most_rows`` keys (counted) are broadcast, so that ``df`` needs no shuffle; more are joined.
    """
    return df.join(small(ids, most_rows), key, how)


def small(rows: DataFrame, most_rows: int = 1_000_000) -> DataFrame:
    """A stored table of a few integer columns, to be broadcast if it has at most ``most_rows`` (counted)."""
    few = rows.limit(most_rows + 1).count() <= most_rows
    return F.broadcast(rows) if few else rows
