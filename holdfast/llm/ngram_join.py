"""N-gram Jaccard join: MinHash bands propose pairs, the full n-gram sets decide.

1. One pass over the texts gives each document the fingerprint of its n-gram set and one hash per band. Equal
   sets are copies: one of them stands for all from here on.
2. Documents are dealt by band hash. In a bucket of at most ``SMALL`` sets, pairs are joined; a larger
   one is split into blocks of about ``BLOCK`` n-grams, and each pair of blocks is a task's group, which compares the
   sets in place and gives back counts and links to the smallest, never pairs. A pair that shares several
   buckets belongs to the first, so no pair is counted twice, and none is left out.
3. The links give classes (connected components).

The number of bands follows from rows per band, similarity and wanted recall. Words are lower-cased and
lose punctuation at both ends. A text with fewer than ``n`` words has one n-gram, all its words.

Defined results: a NULL, empty or wordless text has no n-grams, links with nothing and is a class of its own.
Rows with one doc_id are one document. A row without doc_id takes the class of its copies, NULL if
there are none. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import hold, map_arrow, on_workers, semi, stored, table
from holdfast.llm.components import components

WORDS = 5
SIMILARITY = Fraction(4, 5)
RECALL = 0.9995
MOST_HASHES = 128
SMALL = 16
BLOCK = 400_000
CACHED = 400_000
_PUNCTUATION = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum()) + "…“”‘’«»¿¡–—"


def banding(similarity: float, recall: float, most_hashes: int) -> tuple[int, int]:
    """Bands and rows: the most rows per band with which ``most_hashes`` still reach the recall."""
    best = None
    for rows in range(1, most_hashes + 1):
        shared = similarity ** rows
        bands = max(1, math.ceil(math.log1p(-recall) / math.log1p(-shared))) if shared < 1 else 1
        if bands * rows <= most_hashes:
            best = bands, rows
    if best is None:
        raise ValueError("no banding reaches the recall; allow more hashes")
    return best


class WordHashes(dict):
    """64-bit hash of a chunk of text as a word, 0 if nothing is left of it; bounded."""

    def __missing__(self, chunk: str) -> int:
        word = chunk.lower().strip(_PUNCTUATION)
        value = (xxhash.xxh3_64_intdigest(word) or 1) if word else 0
        if len(self) >= CACHED:
            self.clear()
        if len(chunk) <= 64:
            self[chunk] = value
        return value


_hashes = WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bit mixer (a bijection of 64-bit numbers)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _odd(count: int, seed: int) -> np.ndarray:
    return _mixed(np.arange(1, count + 1, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)


def shingles(text: str | None, n: int = WORDS) -> np.ndarray:
    """Sorted hashes of the different n-grams of a text."""
    chunks = (text or "").split()
    h = np.fromiter(map(_hashes.__getitem__, chunks), np.uint64, len(chunks))
    h = h[h != 0]
    if not len(h):
        return h
    width = min(n, len(h))
    total = np.full(len(h) - width + 1, width, np.uint64)
    for k, factor in enumerate(_odd(n, 7)[:width]):
        total += _mixed(h[k:len(h) - width + 1 + k]) * factor
    return np.unique(_mixed(total))


def signature(grams: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Smallest value of the set under each permutation x -> x * factor."""
    low = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), 2048):
        np.minimum(low, (grams[at:at + 2048, None] * factors).min(axis=0), out=low)
    return low


def band_hashes(low: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per band, different bands apart."""
    total = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k, part in enumerate(low.reshape(bands, rows).T):
        total = _mixed(total ^ part) + np.uint64(k)
    return _mixed(total)


SIGNED = "doc_id bigint, key binary, n int, bands array<bigint>"
SETS = "doc_id bigint, n int, bands array<bigint>, grams binary"


def signed(docs: DataFrame, bands: int, rows: int, n: int = WORDS) -> DataFrame:
    """Set fingerprint, set size and band hashes of each document; key is NULL without n-grams."""
    def sign(batches):
        hold(_hashes)
        factors = _odd(bands * rows, 11)
        for batch in batches:
            keys, sizes, hashes = [], [], []
            for text in batch.column("text"):
                grams = shingles(text.as_py(), n)
                sizes.append(len(grams))
                if len(grams):
                    keys.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest())
                    hashes.append(band_hashes(signature(grams, factors), bands, rows).view(np.int64))
                else:
                    keys.append(None)
                    hashes.append(np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(sizes, pa.int32()), pa.array(hashes, pa.list_(pa.int64()))],
                names=["doc_id", "key", "n", "bands"])

    return map_arrow(docs.select("doc_id", "text"), sign, SIGNED)


def _with_grams(docs: DataFrame, n: int) -> DataFrame:
    """``doc_id, n, bands, grams`` from documents that carry ``n`` and ``bands``."""
    def add(batches):
        hold(_hashes)
        for batch in batches:
            grams = [shingles(t.as_py(), n).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n"), batch.column("bands"),
                 pa.array(grams, pa.binary())], names=["doc_id", "n", "bands", "grams"])

    return map_arrow(docs.select(F.col("doc_id").cast("bigint"), "n", "bands", "text"), add, SETS)


def _least_shared(sizes, similarity: Fraction):
    """Smallest intersection of two sets, given the sum of their sizes, that reaches the similarity."""
    p, q = similarity.numerator, similarity.denominator
    return -(-sizes * p // (p + q))


def _verified(pairs: DataFrame, sets: DataFrame, similarity: Fraction) -> DataFrame:
    """The pairs (a, b) whose sets are similar."""
    def check(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(shared >= _least_shared(len(x) + len(y), similarity))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda c, g: sets.select(F.col("doc_id").alias(c), F.col("grams").alias(g))
    return map_arrow(pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").select("a", "b", "x", "y"),
                     check, "a bigint, b bigint")


def _compare(similarity: Fraction):
    """Links within a pair of blocks: per document how many, and the smallest document it hangs on."""
    def run(group: pa.Table) -> pa.Table:
        bucket, low, high = (group.column(c)[0].as_py() for c in ("bucket", "low", "high"))
        group = group.sort_by("doc_id")
        ids, block = group.column("doc_id").to_numpy(), group.column("block").to_numpy()
        sets = [np.frombuffer(g.as_py(), np.uint64) for g in group.column("grams")]
        bands = np.array(group.column("bands").to_pylist(), np.int64)
        sizes = np.array([len(s) for s in sets], np.int64)
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        _, code = np.unique(np.concatenate(sets), return_inverse=True)
        code = code.reshape(-1)
        flag = np.zeros(int(code.max()) + 1, np.int32)
        links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))

        def find(k: int) -> int:
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        for i in range(len(ids) - 1):
            own = code[starts[i]:starts[i] + sizes[i]]
            flag[own] = 1
            shared = np.add.reduceat(flag[code[starts[i + 1]:]], starts[i + 1:] - starts[i + 1])
            flag[own] = 0
            near = i + 1 + np.flatnonzero(
                (shared >= _least_shared(sizes[i + 1:] + sizes[i], similarity))
                & ((low == high) | (block[i + 1:] != block[i])))
            if len(near):  # a pair belongs to the first bucket that it shares
                first = (bands[near] == bands[i]).argmax(axis=1)
                near = near[bands[i][first] == bucket]
                links[i] += len(near)
                links[near] += 1
                for k in near:
                    x, y = find(i), find(k)
                    root[max(x, y)] = min(x, y)
        got = np.flatnonzero(links)
        return pa.table({"doc_id": pa.array(ids[got], pa.int64()), "links": pa.array(links[got], pa.int64()),
                         "root": pa.array(ids[[find(k) for k in got]] if len(got) else ids[:0], pa.int64())})

    return run


def join(docs: DataFrame, n: int = WORDS, similarity: Fraction = SIMILARITY,
         recall: float = RECALL, most_hashes: int = MOST_HASHES) -> DataFrame:
    """One row per document: ``doc_id, class_id, copy_of, n_copies, n_links``.

    class_id: smallest document that it hangs together with. copy_of: smallest document with the same
    n-grams. n_links: number of other n-gram sets in the table that are similar to its own.
    """
    spark = docs.sparkSession
    on_workers(spark)
    bands, rows = banding(float(similarity), recall, most_hashes)
    sig = stored(signed(docs, bands, rows, n), "signatures")
    copies = stored(sig.filter("key is not null").groupBy("key")
                    .agg(F.min("doc_id").alias("rep"), F.count("*").alias("n_copies")), "copies")
    reps = (sig.join(copies.select("key", F.col("rep").alias("doc_id")), ["key", "doc_id"], "left_semi")
            .dropDuplicates(["doc_id"]).select("doc_id", "n", "bands"))
    dealt = reps.select("doc_id", "n", F.explode("bands").alias("bucket"))
    buckets = (dealt.groupBy("bucket").agg(F.count("*").alias("m"), F.sum("n").alias("total"))
               .filter("m > 1"))
    members = stored(dealt.join(buckets, "bucket"), "members")
    wanted = stored(members.select("doc_id").distinct(), "wanted")
    held = reps.join(wanted, "doc_id", "left_semi")
    texts = semi(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), wanted, "doc_id")
    sets = stored(_with_grams(texts.join(held, "doc_id"), n).dropDuplicates(["doc_id"]), "sets")

    p, q = similarity.numerator, similarity.denominator
    few = (members.filter(F.col("m") <= SMALL).select("bucket", "doc_id")
           .join(sets.select("doc_id", "n", "bands"), "doc_id"))
    a, b = few.alias("a"), few.alias("b")
    pairs = a.join(b, (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.doc_id") < F.col("b.doc_id"))
                   & (F.col("a.n") * q >= F.col("b.n") * p) & (F.col("b.n") * q >= F.col("a.n") * p)
                   & (F.get(F.array_intersect("a.bands", "b.bands"), 0) == F.col("a.bucket")))
    pairs = stored(_verified(pairs.select(F.col("a.doc_id").alias("a"), F.col("b.doc_id").alias("b")),
                             sets, similarity), "pairs", members.count())

    blocks = F.ceil(F.col("total") / BLOCK).cast("int")
    hot = (members.filter(F.col("m") > SMALL)
           .select("bucket", "doc_id", blocks.alias("blocks"))
           .withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
           .select("bucket", "doc_id", "block",
                   F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
           .select("bucket", "doc_id", "block", F.least("block", "other").alias("low"),
                   F.greatest("block", "other").alias("high")))
    met = stored(hot.join(sets.select("doc_id", "bands", "grams"), "doc_id")
                 .groupBy("bucket", "low", "high")
                 .applyInArrow(_compare(similarity), "doc_id bigint, links bigint, root bigint"), "met", members.count())

    links = (pairs.select(F.col("a").alias("doc_id"), F.lit(1).alias("links"))
             .union(pairs.select("b", F.lit(1))).union(met.select("doc_id", "links"))
             .groupBy("doc_id").agg(F.sum("links").cast("bigint").alias("n_links")))
    edges = pairs.union(met.select("doc_id", "root"))
    classes = components(edges, edges.count())
    by_key = (copies.join(links.withColumnRenamed("doc_id", "rep"), "rep", "left")
              .join(classes.select(F.col("node").alias("rep"), "root"), "rep", "left")
              .select("key", "rep", "n_copies", F.coalesce("root", "rep").alias("root"),
                      F.coalesce("n_links", F.lit(0)).alias("n_links")))
    return (sig.select("doc_id", "key").join(by_key, "key", "left")
            .select("doc_id", F.coalesce("root", F.when(F.col("key").isNull(), F.col("doc_id")))
                    .alias("class_id"),
                    F.coalesce("rep", F.when(F.col("key").isNull(), F.col("doc_id"))).alias("copy_of"),
                    F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
                    F.coalesce("n_links", F.lit(0)).alias("n_links")))


def firsts(docs: DataFrame, **options) -> DataFrame:
    """The documents without those that belong to the class of a smaller doc_id."""
    found = join(docs, **options)
    rest = stored(found.filter("doc_id != class_id").select("doc_id").distinct(), "repeats")
    return semi(docs, rest, "doc_id", "left_anti").select(docs.columns)


# ---------------------------------------------------------------- query

def op8_ngram_jaccard_join(spark, sf_dir) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))
