"""A table with unique keys whose changes rewrite only the buckets that they touch.

Rows lie in folders by a hash bucket of the key. A manifest, a small JSON file per version, names the folder of each bucket.
A change writes new folders for the buckets in which a row differs, then the next manifest under its final name, which no
other writer may have taken: readers see the old version or the new one. Folders and manifests that neither the current
version nor a registered reader needs are removed by ``vacuum``.

A manifest has one entry per bucket (``ROWS_PER_BUCKET`` rows each), which is all that the driver holds of the table.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_BUCKET = 2_000_000
BUCKET = "_bucket"


class Conflict(RuntimeError):
    """Another writer has stored the next version first."""


class Files:
    """Small files of the table, through the store's own file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        if not self.fs.exists(self.path(folder)):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(self.path(folder))]

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put(self, name: str, text: str) -> bool:
        """Store a file whole under a name that is not taken yet."""
        part = self.path(f"{name}.{uuid.uuid4().hex}.part")
        stream = self.fs.create(part, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self.fs.exists(self.path(name)) and self.fs.rename(part, self.path(name)):
            return True
        self.fs.delete(part, False)
        return False

    def drop(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class Versioned:
    """The table below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark, root)

    @classmethod
    def create(cls, df: DataFrame, root: str, key: str, buckets: int | None = None) -> Versioned:
        """Store ``df``, whose ``key`` is unique and not NULL, as version 0."""
        table = cls(df.sparkSession, root)
        if table.versions():
            raise Conflict(f"{root} holds a table already")
        buckets = buckets or max(1, -(-df.count() // ROWS_PER_BUCKET))
        folders = table._write(df.withColumn(BUCKET, bucket_of(key, buckets)), buckets)
        table._publish({"version": 0, "key": key, "buckets": buckets, "folders": folders, "applied": {},
                        "schema": df.schema.jsonValue()})
        return table

    def versions(self) -> list[int]:
        return sorted(int(n[1:-5]) for n in self.files.names("manifests") if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        if version is None:
            known = self.versions()
            if not known:
                raise FileNotFoundError(f"{self.root}: no table")
            version = known[-1]
        return json.loads(self.files.read(f"manifests/v{version}.json"))

    def _publish(self, manifest: dict) -> None:
        if not self.files.put(f"manifests/v{manifest['version']}.json", json.dumps(manifest)):
            raise Conflict(f"{self.root}: version {manifest['version']} is taken")

    def _write(self, rows: DataFrame, buckets: int) -> dict[str, str]:
        """New folders of the buckets that have rows; a bucket is one file."""
        folder = f"data/{uuid.uuid4().hex}"
        rows.repartition(buckets, BUCKET).write.partitionBy(BUCKET).parquet(f"{self.root}/{folder}")
        return {n.split("=")[1]: f"{folder}/{n}" for n in self.files.names(folder) if n.startswith(f"{BUCKET}=")}

    def _read(self, manifest: dict, buckets: list[str] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        paths = [f"{self.root}/{f}" for b, f in sorted(manifest["folders"].items()) if buckets is None or b in buckets]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame:
        return self._read(self.manifest(version))

    @contextmanager
    def reading(self, version: int | None = None) -> Iterator[DataFrame]:
        """The table as it is now, kept from ``vacuum`` until the block ends."""
        name = f"readers/{uuid.uuid4().hex}"
        while True:
            found = self.manifest(version)
            self.files.put(name, json.dumps({"version": found["version"], "since": time.time()}))
            if found["version"] in self.versions():  # not removed in between
                break
            self.files.drop(name)
        try:
            yield self._read(found)
        finally:
            self.files.drop(name)

    def merge(self, updates: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame],
              source: str | None = None, batch: int | None = None, inserts: bool = False) -> list[str]:
        """Store the next version with ``change(rows, updates)`` in the buckets where it says ``changed``; returns these.

        ``change`` gives the rows of the touched buckets and a boolean column ``changed``. A ``batch`` of a ``source`` that is
        stored already, and one that changes nothing, write no folder. With ``inserts``, ``change`` may add rows for updates
        whose key is new; it gets only the updates of the buckets it reads, and buckets without rows are touched too.
        """
        now = self.manifest()
        if batch is not None and now["applied"].get(source or "", -1) >= batch:
            return []
        key, buckets = now["key"], now["buckets"]
        at = bucket_of(key, buckets)
        touched = [str(r[0]) for r in updates.select(at.alias("b")).distinct().collect()]  # one row per bucket at most
        touched = [b for b in touched if inserts or b in now["folders"]]
        differ, folders = [], {}
        if touched:
            rows = change(self._read(now, touched), updates)
            differ = sorted(str(r[0]) for r in rows.where("changed").select(at.alias("b")).distinct().collect())
        if differ:
            some = updates.where(at.isin([int(b) for b in differ])) if inserts else updates
            rows = change(self._read(now, differ), some).drop("changed")
            folders = self._write(rows.withColumn(BUCKET, at), buckets)
        if not differ and batch is None:
            return []
        applied = now["applied"] if batch is None else now["applied"] | {source or "": batch}
        self._publish(now | {"version": now["version"] + 1, "folders": now["folders"] | folders, "applied": applied})
        return differ

    def vacuum(self, reader_hours: float = 24.0) -> list[str]:
        """Remove what neither the current version nor a reader of the last ``reader_hours`` needs; returns the folders."""
        current = self.manifest()
        needed = {current["version"]}
        for name in self.files.names("readers"):
            lease = json.loads(self.files.read(f"readers/{name}"))
            if lease["since"] >= time.time() - 3600 * reader_hours:
                needed.add(lease["version"])
            else:
                self.files.drop(f"readers/{name}")
        old = [v for v in self.versions() if v < current["version"] and v not in needed]
        held = {f for v in needed if v in self.versions() for f in self.manifest(v)["folders"].values()}
        gone = sorted({f for v in old for f in self.manifest(v)["folders"].values()} - held)
        for folder in gone:
            self.files.drop(folder)
        for version in old:
            self.files.drop(f"manifests/v{version}.json")
        return gone
