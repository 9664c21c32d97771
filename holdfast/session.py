"""Session helpers: builder, checkpoint folder, scratch folders."""

from __future__ import annotations

import gc
import tempfile
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SMALL_ROWS = 200_000  # proven row bound below which one task or a broadcast is fine
SMALL_BYTES = 64 << 20  # and the bound on their text form for a broadcast


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "holdfast", **conf: str) -> SparkSession:
    """Session with the settings the plans assume (all are defaults a cluster may override)."""
    builder = (SparkSession.builder.appName(app_name)
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.codegen.cache.maxEntries", "2000")
               .config("spark.ui.enabled", "false"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_local_folders: dict[str, tempfile.TemporaryDirectory] = {}  # gone when the program ends
_one_folder = threading.Lock()


def _shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or a temp folder in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    with _one_folder:  # steps that run together ask for it at the same time
        if sc.applicationId not in _local_folders:
            _local_folders[sc.applicationId] = tempfile.TemporaryDirectory(
                prefix="holdfast-", ignore_cleanup_errors=True)
    return _local_folders[sc.applicationId].name


def cut(df: DataFrame) -> DataFrame:
    """Fix the rows of ``df`` on shared storage and drop its lineage: Parquet below the shared folder, so that later
    reads take only the columns they need and ``drop_scratch`` finds it."""
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """``cut`` plus the row count, taken from the stored rows."""
    fixed = cut(df)
    return fixed, fixed.count()


def cut_measured(df: DataFrame) -> tuple[DataFrame, bool]:
    """``cut``, and whether the rows are few and short enough to be sent to every task, measured while they are written.
    A task that ran twice counts twice, so the measure is never too small."""
    wide = [F.octet_length(F.to_json(F.struct(c)) if isinstance(t, (T.ArrayType, T.MapType, T.StructType)) else F.col(c))
            for c, t in ((f"`{f.name}`", f.dataType) for f in df.schema.fields)
            if isinstance(t, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType))]
    size = F.sum(sum((F.coalesce(w, F.lit(0)) for w in wide), F.lit(16 * len(df.columns))).cast("bigint"))
    seen = Observation()
    fixed = cut(df.observe(seen, F.count(F.lit(1)).alias("rows"), size.alias("size")))
    got = seen.get
    if "rows" not in got:  # a plan known to be empty has nothing to observe
        return fixed, fits_broadcast(fixed)
    return fixed, got["rows"] <= SMALL_ROWS and (got["size"] or 0) <= SMALL_BYTES


def fits_broadcast(fixed: DataFrame, most_rows: int = SMALL_ROWS, most_bytes: int = SMALL_BYTES) -> bool:
    """Whether stored rows are few and short enough to be sent to every task. No more than ``most_rows`` are read."""
    size = F.sum(F.length(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})))
    rows, size = fixed.limit(most_rows + 1).agg(F.count("*"), size).first()
    return rows <= most_rows and (size or 0) <= most_bytes


def literal_rows(spark: SparkSession, rows: list[dict[str, Column]]) -> DataFrame:
    """A few constant rows, without shipping Python objects."""
    structs = [F.struct(*[c.alias(n) for n, c in row.items()]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def together(spark: SparkSession, tasks: dict[str, Callable[[], Any]]) -> dict[str, Any]:
    """Run independent actions at the same time, so that small jobs share the executors."""
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(task))
                   for name, task in tasks.items()}
        return {name: future.result() for name, future in running.items()}


def in_turn(spark: SparkSession, tasks: dict[str, Callable[[], Any]]) -> dict[str, Any]:
    """``together`` for actions of which each keeps the executors busy: one after the other, and the driver collects what
    one has left before the next begins."""
    done = {}
    for name, task in tasks.items():
        release(spark)
        done[name] = task()
    return done


def release(spark: SparkSession) -> None:
    """Let the driver collect what finished steps left behind: plans, task binaries, sampled rows. Left alone, its heap grows
    towards its limit before it does, and Spark drops broadcasts and shuffle files only after that."""
    gc.collect()  # Python's references first: each of them holds an object of the JVM
    spark.sparkContext._jvm.System.gc()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the application's part of the shared folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def scratch_root(spark: SparkSession) -> str:
    return f"{_shared_dir(spark).rstrip('/')}/holdfast/{spark.sparkContext.applicationId}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application stored between steps. Call it when no result is read any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
