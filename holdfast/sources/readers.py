"""Feed and warehouse readers."""

from __future__ import annotations

import csv
import logging
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast import contract as K
from holdfast.functions.columns import strip, to_number, to_whole
from holdfast.session import literal_rows
from holdfast.sources.quoted import records

log = logging.getLogger(__name__)


def check_columns(actual: list[str], expected: list[str], name: str) -> list[str]:
    """Missing columns raise; the list of extra ones is returned and logged."""
    missing = [c for c in expected if c not in actual]
    extra = [c for c in actual if c not in expected]
    if missing:
        raise K.SchemaError(f"{name}: missing columns {missing}")
    if extra:
        log.warning("%s: unexpected extra columns ignored: %s", name, extra)
    return extra


def select_contract(df: DataFrame, expected: list[str], name: str) -> DataFrame:
    """Contract columns in contract order. Only the schema is looked at; no job runs."""
    check_columns(df.columns, expected, name)
    return df.select(*expected)


#: Quoted CSV: a doubled quote is a quote, a row with too many or too few cells fails.
QUOTED = {"quote": '"', "escape": '"', "mode": "FAILFAST", "columnPruning": "false"}
HEAD = 1 << 13  # bytes of a file that are read for its header at first


def _csv(spark: SparkSession):
    """Reader of quoted CSV with a header, without line breaks in cells."""
    return spark.read.option("header", True).options(**QUOTED)


def _head(jvm, conf, file: str) -> tuple[str, str | None]:
    """A file as Spark names it, and its first record, read through the store's own file system; None if it is empty."""
    path = jvm.org.apache.hadoop.fs.Path(file)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    opened = path.getFileSystem(conf).open(path)
    try:
        stream = codec.createInputStream(opened) if codec else opened
        data, size = b"", HEAD
        while True:
            more = bytes(stream.readNBytes(size))
            data, size = data + more, 2 * size
            at = data.find(b"\n")
            while at >= 0 and data.count(b'"', 0, at) % 2:  # a line break inside a cell
                at = data.find(b"\n", at + 1)
            if at >= 0 or not more:
                break
        return path.toString(), data[:at if at >= 0 else None].decode("utf-8-sig").rstrip("\r") if data else None
    finally:
        opened.close()


def headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Files by their header, as column names; empty files have none. Only the first kilobytes of each file are read, many
    files at a time, and no Spark job runs."""
    files = spark.read.format("binaryFile").load(path).inputFiles()
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    with ThreadPoolExecutor(max_workers=16) as pool:
        heads = list(pool.map(lambda file: _head(jvm, conf, unquote(file)), files))
    found: dict[tuple[str, ...], list[str]] = {}
    for file, head in heads:
        if head is not None:
            found.setdefault(tuple(next(csv.reader([head]), ())), []).append(file)
    return {names: sorted(files) for names, files in sorted(found.items())}


def _scans(spark: SparkSession, path: str, expected: list[str] | None,
           multi_line: bool = False) -> list[DataFrame]:
    """One scan per header, so that every file's cells are named by its own header; each header has to hold
    the ``expected`` columns. ``_at`` is a row's place: file, offset of the block, row in the block."""
    scans = []
    for names, files in headers(spark, path).items():
        if expected is not None:
            check_columns(list(names), expected, f"{path} ({len(files)} files, first {files[0]})")
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        if multi_line:
            rows = records(spark, files)
            ddl = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
            cells = F.from_csv("record", ddl, {**QUOTED, "nullValue": "\u0000", "multiLine": "true"})
            scans.append(rows.select(cells.alias("_cells"), F.struct(
                "file_path", F.col("at").alias("file_block_start"), "row").alias("_at")).select("_cells.*", "_at"))
            continue
        read = _csv(spark).schema(schema).option("enforceSchema", False).option("nullValue", "\u0000").csv(files)
        scans.append(read.select("*", F.struct("_metadata.file_path", "_metadata.file_block_start",
                                               F.monotonically_increasing_id().alias("row")).alias("_at")))
    return scans


def _together(parts: list[DataFrame], spark: SparkSession, columns: list[str]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _text(columns: list[str]) -> list[Column]:
    """An unquoted empty cell reads as NULL; here blank cells are empty text."""
    return [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns]


def read_text_csv(spark: SparkSession, path: str, columns: list[str] | None = None,
                  multi_line: bool = False) -> DataFrame:
    """Every cell as text, named by the header of its file; blank cells stay empty text.

    With ``columns`` each file has to have them, in any order, and only they are returned. Cells with line breaks need
    ``multi_line`` (``sources.quoted``), which also shares a file among tasks.
    """
    scans = _scans(spark, path, columns, multi_line)
    return _together([d.select(*_text(columns or [c for c in d.columns if c != "_at"])) for d in scans], spark, columns or [])


def read_customers(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Raw customer feed plus ``feed_seq``, the arrival order: file, offset of the file
    block, row inside the block. It is the same however often a block is read again."""
    scans = _scans(spark, path, K.RAW_COLUMNS, multi_line)
    seq = F.col("_at").alias("feed_seq")
    if not scans:
        empty = ", ".join(f"`{c}` string" for c in K.RAW_COLUMNS)
        return spark.createDataFrame(
            [], empty + ", feed_seq struct<file_path:string,file_block_start:bigint,row:bigint>")
    return reduce(DataFrame.unionByName, [d.select(*_text(K.RAW_COLUMNS), seq) for d in scans])


def coerce_telemetry(df: DataFrame) -> DataFrame:
    """Text telemetry to types: bad numbers become NULL, bad complaint counts become 0."""
    return df.select(
        strip("customer_id").alias("customer_id"), "month",
        F.col("month_index").cast("int").alias("month_index"),
        *[to_number(c).alias(c) for c in ("dropped_call_pct", "avg_download_mbps",
                                          "avg_latency_ms")],
        to_number("outage_minutes").alias("outage_minutes"),
        to_number("data_usage_gb").alias("data_usage_gb"),
        to_whole("complaints").alias("complaints"))


def read_telemetry(spark: SparkSession, path: str) -> DataFrame:
    return coerce_telemetry(read_text_csv(spark, path, K.TELEMETRY_COLUMNS))


def read_optional_telemetry(spark: SparkSession, path: str | None) -> DataFrame | None:
    """None when no path is given or nothing exists there."""
    if not path:
        return None
    try:
        return read_telemetry(spark, path)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def content_digest(columns: list[str]) -> Column:
    """Digest of many rows that does not depend on their order or on how they are split into files: the sum of
    60 bits of each row's MD5. Sums of parts add up, so tasks share the work on a large file."""
    row = F.md5(F.concat_ws("\u0001", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns]))
    return F.sum(F.conv(F.substring(row, 1, 15), 16, 10).cast("decimal(20,0)")).cast("string")


def verify_intake(spark: SparkSession, path: str, expected: list[str] = K.RAW_COLUMNS,
                  expected_rows: int | None = None, expected_digest: str | None = None,
                  sha256_up_to: int = 0) -> DataFrame:
    """One row per file: length, rows, content digest, whether its header is exactly the expected one, and whether
    rows and digest of the whole feed are as expected (NULL: nothing expected).

    SHA-256 reads a file as one row, so it is taken only where ``sha256_up_to`` bytes are allowed, at most 1 GB, and
    a larger file is refused.
    """
    parts = []
    for names, files in headers(spark, path).items():
        scan = (_csv(spark).schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
                .option("enforceSchema", False).option("nullValue", "\u0000").csv(files))
        ok = list(names) == expected
        known = [c for c in expected if c in names]
        parts.append(scan.groupBy(F.url_decode("_metadata.file_path").alias("path")).agg(
            F.count("*").alias("rows"), (content_digest(known) if known else F.lit(None).cast("string"))
            .alias("digest")).withColumn("header_ok", F.lit(ok)))
        parts.append(literal_rows(spark, [{"path": F.lit(f), "rows": F.lit(0).cast("bigint"),
                                           "digest": F.lit(None).cast("string"), "header_ok": F.lit(ok)}
                                          for f in files]))  # a file may hold its header alone
    if not parts:
        raise FileNotFoundError(f"{path}: no file with a header")
    seen = reduce(DataFrame.unionByName, parts).groupBy("path").agg(
        F.sum("rows").alias("rows"), F.max("digest").alias("digest"), F.min("header_ok").alias("header_ok"))
    files, name = spark.read.format("binaryFile").load(path), F.url_decode("_metadata.file_path").alias("path")
    if sha256_up_to:
        limit = min(sha256_up_to, 1 << 30)
        digest = F.when(F.col("length") <= limit, F.sha2("content", 256)).otherwise(
            F.raise_error(F.concat("path", F.lit(f": longer than {limit} bytes, no SHA-256"))))
        files = files.select(name, "length", digest.alias("sha256"))
    else:
        files = files.select(name, "length", F.lit(None).cast("string").alias("sha256"))
    total = seen.agg(F.struct(F.sum("rows").alias("rows"), F.sum(F.col("digest").cast("decimal(38,0)"))
                              .cast("string").alias("digest"))).scalar()

    def same(value: Column, wanted) -> Column:
        return F.lit(None).cast("boolean") if wanted is None else value == F.lit(wanted)

    return (seen.join(files, "path", "left")
            .select("path", "length", "sha256", "header_ok", "rows", "digest",
                    same(total["rows"], expected_rows).alias("rows_ok"),
                    same(total["digest"], expected_digest).alias("digest_ok")))


def typed_load(spark: SparkSession, path: str, table: str) -> DataFrame:
    """CSV straight into the declared column types. Blank cells are NULL, or the column's declared default; a
    cell that does not fit its type, or a header that does not match, fails the load."""
    schema = ", ".join(f"`{c}` {t}" for c, t in K.TYPED_LOAD[table].items())
    loaded = _csv(spark).schema(schema).option("enforceSchema", False).csv(path)
    return loaded.fillna(K.LOAD_DEFAULTS[table]) if table in K.LOAD_DEFAULTS else loaded


def load_star(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All star tables, dimensions before facts."""
    return {name: typed_load(spark, f"{root}/{name}", name) for name in K.TYPED_LOAD}
