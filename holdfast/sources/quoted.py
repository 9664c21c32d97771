"""CSV files whose quoted cells hold line breaks, read by many tasks.

A line break ends a record only if an even number of quotes stands before it. What a task needs to know of the bytes before its
own is therefore one bit. A first scan counts the quotes of each block of a file; the running parity over the blocks (one row
each) tells which blocks begin inside a cell. A second scan cuts each block at its even line breaks. A record that goes over
blocks comes out in pieces, two at most of each block; these few rows are put together by file and place.

A quote belongs around a cell or is doubled inside one. A single quote within an unquoted cell would turn the parity over; the
rows behind it then have too many or too few cells and fail the read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast.session import cut, fits_broadcast

WHOLE, ENDS, INSIDE, BEGINS = range(4)  # a record; the end, a middle part, the beginning of one that goes over blocks
RECORDS = "file_path string, at bigint, row bigint, kind int, record string"


def lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """``value, file_path, at, n`` of each line; at is the offset of its block, n follows the lines of a block."""
    return spark.read.option("lineSep", "\n").text(files).select(
        "value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("n"))


def odd_blocks(text: DataFrame) -> DataFrame:
    """``file_path, at, inside`` of the blocks that begin inside a cell. A file that ends inside one fails the read."""
    quotes = F.sum(F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))))
    blocks = text.groupBy("file_path", "at").agg(F.pmod(quotes, F.lit(2)).alias("odd"))
    upto = W.partitionBy("file_path").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    run = blocks.select("file_path", "at", "odd", F.pmod(F.sum("odd").over(upto), F.lit(2)).alias("after"),
                        F.lead("at").over(W.partitionBy("file_path").orderBy("at")).alias("next"))
    broken = F.when((F.col("after") == 1) & F.col("next").isNull(),
                    F.raise_error(F.concat("file_path", F.lit(": ends inside a quoted cell"))).cast("boolean"))
    return (run.withColumn("inside", F.coalesce(broken, F.col("after") != F.col("odd")))
            .where("inside").select("file_path", "at", "inside"))


def _cut_blocks(batches):
    """Lines in file order to records and to pieces of records that go over the block."""
    block, row, held, inside = None, 0, [], False

    def rest():
        """What is left of a block whose last record goes on."""
        if held:
            yield (*block, row, INSIDE if inside else BEGINS, "\n".join(held))

    for batch in batches:
        values = batch.column("value").fill_null("")
        odd = pc.bit_wise_and(pc.count_substring(values, '"'), 1).to_numpy().astype(bool)
        texts = values.to_pylist()
        files, at, begin = (batch.column(c).to_pylist() for c in ("file_path", "at", "inside"))
        out = []
        edges = np.flatnonzero([i == 0 or at[i] != at[i - 1] or files[i] != files[i - 1] for i in range(len(at))])
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(at)]):
            if block != (files[a], at[a]):
                out += rest()
                block, row, held, inside = (files[a], at[a]), 0, [], bool(begin[a])
                open_ = inside
            for i in range(a, b):
                open_ ^= bool(odd[i])
                if open_:
                    held.append(texts[i])
                    continue
                record = "\n".join([*held, texts[i]]) if held else texts[i]
                out.append((*block, row, ENDS if inside else WHOLE, record))
                row, held, inside = row + 1, [], False
        if out:
            yield _batch(out)
    last = list(rest())
    if last:
        yield _batch(last)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      names=[c.split()[0] for c in RECORDS.split(", ")])


def records(spark: SparkSession, files: list[str]) -> DataFrame:
    """``file_path, at, row, record``: every record of the files but their headers, as text; (at, row) follow the file.

    Blank lines are no records. ``\\r\\n`` is a line break like ``\\n``. A file that ends inside a cell fails the read.
    """
    text = lines(spark, files)
    odd = cut(odd_blocks(text))
    if odd.isEmpty():
        marked, split = text.withColumn("inside", F.lit(False)), False
    elif fits_broadcast(odd):
        marked, split = text.join(F.broadcast(odd), ["file_path", "at"], "left"), True
    else:  # a shuffled join loses the order of the lines
        marked, split = text.join(odd, ["file_path", "at"], "left").repartition("file_path", "at").sortWithinPartitions(
            "file_path", "at", "n"), True
    found = marked.select("value", "file_path", "at", F.coalesce("inside", F.lit(False)).alias("inside")).mapInArrow(
        _cut_blocks, RECORDS)
    every = found.where(F.col("kind") == WHOLE).select("file_path", "at", "row", "record")
    if split:
        every = every.unionByName(_joined(found))
    clean = F.regexp_replace(F.replace("record", F.lit("\r\n"), F.lit("\n")), r"\r\z", "")
    return (every.where((F.col("at") > 0) | (F.col("row") > 0)).withColumn("record", clean)
            .where(F.trim("record") != ""))


def _joined(found: DataFrame) -> DataFrame:
    """The records that go over blocks, put together."""
    # pieces are few: two of a block at most; a beginning opens a record that lasts until the next end
    pieces = cut(found.where(F.col("kind") != WHOLE))
    place = W.partitionBy("file_path").orderBy("at", "row")
    return (pieces.withColumn("n", F.sum((F.col("kind") == BEGINS).cast("int")).over(place))
            .groupBy("file_path", "n").agg(
                F.min(F.struct("at", "row")).alias("first"),
                F.transform(F.array_sort(F.collect_list(F.struct("at", "row", "record"))),
                            lambda p: p["record"]).alias("parts"))
            .select("file_path", "first.at", "first.row", F.array_join("parts", "\n").alias("record")))
