"""Approximate nearest neighbours by multi-index hashing: learned rotated binary codes, each substring indexed.

1. Equal vectors are one class: a class keeps its ``TOP`` + 1 smallest ids, enough for every query, and queries of a class are
   searched once. So many copies of a vector cost one row.
2. Rotations are learned on a documented sample (``SAMPLE`` vectors at most, those with the least hashes of their ids): the
   directions of the centred unit vectors, rotated so that signs lose least. Every row is indexed, not only the sample.
3. Vectors are dealt to blocks of about ``BLOCK`` by a hash, queries to parts, and a task has a block and a part. It codes the
   block in ``BITS`` bits and indexes each substring of 16 bits: vectors sorted by its value, with a place for each value.
4. Probing: a code within ``m * (t + 1) - 1`` of a query's, m substrings, has a substring within t bits, so the values within
   t bits of each of the query's substrings hold all of them. t grows until ``ENOUGH`` codes lie within half that radius.
   Beyond ``MOST_PROBED`` more values would be probed than there are vectors: then the query's code is compared with all codes of
   the block, which is what probing all values gives, and the radius is that of the ``ENOUGH``-th nearest code.
5. All codes within the radius are ranked by cosine of the original vectors in double precision; a task gives back ``TOP`` + 1 ids
   a query. The best of all blocks are the answer.

The stated queries meet all vectors, in blocks: rows shuffled are vectors times parts and queries times blocks, and a task
holds one block and one part. No candidate pair leaves a task.

Recall against brute force is stated in the README and tested. Defined results: vectors that are NULL, zero, empty, or hold a
NULL or non-finite component take no part, nor do rows without vec_id, nor vectors of another length than most (ties: the
greater length). Repeated rows are one; of different vectors under one vec_id the one with the least hash takes part. Other
columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from holdfast.llm.common import on_workers, small, stored, table

TOP = 5
EVERY = 50  # queries are the rows whose vec_id this divides
BITS = 256
SUB = 16  # bits of a substring
SAMPLE = 20_000  # vectors the rotations are learned on, at most
SAMPLE_BYTES = 64 << 20
ROUNDS = 15
BLOCK = 16_384
PART = 16_384
ENOUGH = 320
MOST_PROBED = 2


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding, n, k1, k2`` of the vectors that take part; k1 and k2 are hashes of the vector."""
    inf = F.lit(float("inf"))
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    some = F.exists("embedding", lambda x: x != 0)
    return (vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
            .filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(sound).filter(some)
            .select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), F.size("embedding").alias("n"),
                    F.xxhash64("embedding").alias("k1"), F.xxhash64(F.lit(1), "embedding").alias("k2")))


def classes(rows: DataFrame, top: int = TOP, every: int = EVERY) -> tuple[DataFrame, DataFrame]:
    """Classes of equal vectors (``rep, ids, asks, embedding``), and ``query_id, rep`` of the queries."""
    one = rows.groupBy("vec_id").agg(F.min(F.struct("k1", "k2")).alias("k")).select("vec_id", "k.k1", "k.k2")
    one = stored(one, "vector-ids")
    order = Window.partitionBy("k1", "k2").orderBy("vec_id")
    least = one.withColumn("_at", F.row_number().over(order)).filter(F.col("_at") <= top + 1)
    asked = one.filter(F.pmod("vec_id", F.lit(every)) == 0)
    found = (least.groupBy("k1", "k2").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
             .select("k1", "k2", F.get("ids", F.lit(0)).alias("rep"), "ids"))
    found = stored(found, "vector-classes")
    queries = stored(asked.join(found.select("k1", "k2", "rep"), ["k1", "k2"])
                     .select(F.col("vec_id").alias("query_id"), "rep"), "vector-queries")
    asks = queries.select("rep").distinct().withColumn("asks", F.lit(True))
    held = (found.join(asks, "rep", "left").withColumnRenamed("rep", "vec_id")
            .join(rows.select("vec_id", "k1", "k2", "embedding"), ["vec_id", "k1", "k2"]).dropDuplicates(["vec_id"])
            .select(F.col("vec_id").alias("rep"), "ids", F.coalesce("asks", F.lit(False)).alias("asks"), "embedding"))
    return stored(held, "vectors"), queries


def _rotation(codes: np.ndarray, rng: np.random.Generator, rounds: int) -> np.ndarray:
    """The rotation of centred rows whose signs are closest to them: signs and rotation are fitted in turn."""
    r = np.linalg.qr(rng.standard_normal((codes.shape[1],) * 2))[0]
    for _ in range(rounds):
        signs = np.where(codes @ r >= 0, 1.0, -1.0)
        u, _, w = np.linalg.svd(codes.T @ signs)
        r = u @ w
    return r


def learn(sample: np.ndarray, bits: int = BITS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Mean, and the matrix whose signs are the code: as many rotations of the main directions as fill the bits."""
    rng = np.random.default_rng(0)
    unit = _unit(sample)
    mean = unit.mean(axis=0)
    centred = unit - mean
    _, _, main = np.linalg.svd(centred.T @ centred)
    main = main[:min(bits, main.shape[0])].T
    parts = [main @ _rotation(centred @ main, rng, rounds) for _ in range(-(-bits // main.shape[1]))]
    return mean, np.concatenate(parts, axis=1)[:, :bits]


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no square over- or underflows
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def code(x: np.ndarray, mean: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Codes as rows of unsigned 16-bit substrings."""
    return np.packbits((_unit(x) - mean) @ matrix >= 0, axis=1).view(np.uint16)


def flips(t: int) -> np.ndarray:
    """The substrings' values that differ from 0 in exactly t bits."""
    return np.array([sum(1 << b for b in c) for c in itertools.combinations(range(SUB), t)], np.uint16)


class Index:
    """Substring tables of the codes of one block."""

    def __init__(self, codes: np.ndarray):
        self.codes = np.ascontiguousarray(codes)
        self.words = self.codes.view(np.uint64)
        n, m = codes.shape
        self.order = np.argsort(codes.T, axis=1, kind="stable").astype(np.int32)
        self.start = np.zeros((m, (1 << SUB) + 1), np.int32)
        for j in range(m):
            np.cumsum(np.bincount(codes[:, j], minlength=1 << SUB), out=self.start[j, 1:])

    def probe(self, query: np.ndarray, t: int) -> np.ndarray:
        """Places of the vectors that have a substring exactly t bits off, some more than once."""
        values = query[:, None] ^ flips_of[t][None, :]
        rows = np.arange(len(query))[:, None]
        a, b = self.start[rows, values], self.start[rows, values.astype(np.int32) + 1]
        n = (b - a).ravel()
        hit = np.flatnonzero(n)
        n = n[hit]
        first = (a + rows * len(self.codes)).ravel()[hit]
        ends = np.cumsum(n)
        return self.order.ravel()[np.repeat(first - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]

    def distances(self, query: np.ndarray, at=slice(None)) -> np.ndarray:
        return np.bitwise_count(self.words[at] ^ query.view(np.uint64)).sum(axis=1, dtype=np.int32)

    def near(self, query: np.ndarray, enough: int = ENOUGH, most_probed: int = MOST_PROBED) -> np.ndarray:
        """Places of all codes within the radius that holds enough of them."""
        n, m = self.codes.shape
        if n > enough:
            seen = np.zeros(n, bool)
            for t in range(most_probed + 1):
                seen[self.probe(query, t)] = True
                at = np.flatnonzero(seen)
                radius = m * (t + 1) - 1
                away = self.distances(query, at)
                if (away <= radius // 2).sum() >= enough:
                    return at[away <= radius]
            away = self.distances(query)
            return np.flatnonzero(away <= np.partition(away, enough - 1)[enough - 1])
        return np.arange(n)


flips_of = [flips(t) for t in range(MOST_PROBED + 1)]


def _searched(mean: np.ndarray, matrix: np.ndarray, top: int, enough: int):
    """The best ids of a block for the queries of a part."""
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("rep")
        asks = group.column("ask").to_numpy()
        vectors = np.array(group.column("embedding").combine_chunks().flatten()).reshape(len(group), -1)
        block, asked = np.flatnonzero(~asks), np.flatnonzero(asks)
        out = []
        if len(block) and len(asked):
            x = vectors[block]
            scaled = x / np.abs(x).max(axis=1, keepdims=True)
            norms = np.sqrt((scaled * scaled).sum(axis=1))
            index, codes = Index(code(x, mean, matrix)), code(vectors[asked], mean, matrix)
            ids = group.column("ids").combine_chunks().take(pa.array(block))
            ids_of, ends = np.array(ids.flatten()), ids.offsets.to_numpy()
            reps = group.column("rep").to_numpy()
            for k, q in enumerate(asked):
                at = index.near(codes[k], enough)
                v = vectors[q] / np.abs(vectors[q]).max()
                score = (scaled[at] * v).sum(axis=1) / (norms[at] * np.sqrt((v * v).sum()))
                best = np.argsort(-score, kind="stable")
                keep = score >= score[best[min(top, len(best) - 1)]]  # ties of the last place too
                found = [(-s, i) for p, s in zip(at[keep].tolist(), score[keep].tolist())
                         for i in ids_of[ends[p]:ends[p + 1]].tolist()]
                out += [(reps[q], i, -s) for s, i in sorted(found)[:top + 1]]
        a, b, c = zip(*out) if out else ((), (), ())
        return pa.table({"rep": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()),
                         "score": pa.array(c, pa.float64())})

    return run


FOUND = "rep bigint, vec_id bigint, score double"
ANSWER = "query_id bigint, rank int, vec_id bigint, score double"


def _dealt(c: str, seed: int, parts: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), c), F.lit(parts)).cast("int")


def nearest(vectors: DataFrame, top: int = TOP, every: int = EVERY, bits: int = BITS, block: int = BLOCK,
            part: int = PART, enough: int = ENOUGH) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest found of each query."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    usual = rows.groupBy("n").count().orderBy(F.desc("count"), F.desc("n")).first()
    if usual is None:
        return spark.createDataFrame([], ANSWER)
    on_workers(spark)
    held, queries = classes(rows.filter(F.col("n") == usual.n), top, every)
    n_sample = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * usual.n)))
    sample = held.select("embedding").orderBy(F.xxhash64("rep"), "rep").limit(n_sample).toArrow()
    mean, matrix = learn(np.array(sample.column(0).combine_chunks().flatten()).reshape(-1, usual.n), bits)
    n, asked = held.agg(F.count("*"), F.count_if("asks")).first()
    blocks, parts = -(-n // block), max(1, -(-asked // part))
    every_one = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    index = held.select(_dealt("rep", 3, blocks).alias("block"), every_one(parts).alias("part"), F.lit(False).alias("ask"),
                        "rep", "ids", "embedding")
    asking = held.filter("asks").select(every_one(blocks).alias("block"), _dealt("rep", 5, parts).alias("part"),
                                        F.lit(True).alias("ask"), "rep", F.array().cast("array<bigint>").alias("ids"),
                                        "embedding")
    found = index.union(asking).groupBy("block", "part").applyInArrow(_searched(mean, matrix, top, enough), FOUND)
    found = stored(found, "vector-found")
    best = Window.partitionBy("rep").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("_at", F.row_number().over(best)).filter(F.col("_at") <= top + 1).drop("_at")
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (small(queries).join(found, "rep").filter("vec_id != query_id")
            .withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= top)
            .select("query_id", "rank", "vec_id", "score"))


# ---------------------------------------------------------------- query

def op12_multi_index_hashing(spark, sf_dir) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
