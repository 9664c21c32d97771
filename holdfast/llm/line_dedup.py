"""Fuzzy line dedup: MinHash over character n-grams, exact Jaccard, union-find, one line per component.

1. A line is known by a 64-bit hash of what is compared (small letters, no blanks at the ends); a second hash finds
   different lines with one first hash, and those get another. Its shingles are all its overlapping runs of ``SHINGLE``
   characters, blanks and marks included; a shorter line is one shingle.
2. MinHash: the k-th permutation XORs a shingle's 32-bit hash with a number and multiplies it by an odd one, both its own.
   ``ROWS`` smallest values make a band; how many bands follows from ``RECALL``, the chance that a pair at ``PCT`` percent
   meets in a bucket. Many rows keep strangers apart: a pair at 40 percent meets with a chance of 0.19.
3. Lines that share a bucket are read again, for their number of shingles and four bits of each smallest value. In a bucket
   each line meets one of them, first on these columns; texts are joined only for pairs of like size that agree in as many
   values as a pair at ``PCT`` percent does (but for one in 100,000), and the full shingle sets decide.
4. Components follow from these links. Lines of a bucket that are then still in different components are compared: up to
   ``FEW`` by the same columns and texts, more of them in place, in pairs of blocks of about ``BLOCK`` shingles, which give
   back links that join components, never pairs.
5. Of each component the first line (by doc_id, then place) stays.

Shingles are rolling hashes in Arrow batches inside the tasks, for the signatures and for the comparison, and the buckets of
a task are sorted there as numbers; all else is DataFrame expressions. Equal lines of a batch have one row of band hashes; the
shuffle by bucket moves arrays of them, and equal lines meet there. Joins are on keys that are unique on one side. A bucket of m lines costs at most m rows a pair of blocks and m * m comparisons of some bytes.

Defined results: a NULL or empty text has no lines. Lines without a word are no duplicates and stay. Rows with one
doc_id and one text (known by its 64-bit hash) are one document and lose the same lines; other rows lose their own.
Rows without a doc_id come last in the order. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import BLANK, WORD, in_parts, let, map_arrow, on_workers, small, stored, table
from holdfast.llm.components import components
from holdfast.llm.ngram_join import _mixed, _odd, banding

SHINGLE = 7
PAD = "\U0010ffff"  # fills lines shorter than a shingle
PCT = 80
RECALL = 0.9995
MOST_HASHES = 100
BANDS, ROWS = banding(PCT / 100, RECALL, MOST_HASHES)
BLOCK = 400_000
DEALT = 2_000_000  # buckets and ids (16 bytes a pair) that a task sorts, and that are held before they are dealt
PAIRS = 1 << 16  # pairs of lines of a block that are compared by columns at once
FEW = 16  # lines of a bucket whose pairs are compared by a join on columns
HUBS = 4  # orders of the lines by which a bucket's chosen line is the first
MOST_SENT = 2_000_000  # ids or places (8 bytes each) that are broadcast at most, counted before
PLANES = 4  # bits of each smallest value that are compared before texts are


def has_word(line: Column) -> Column:
    """Whether the line has a word; reads no further than to its first letter."""
    return F.ltrim(line, F.lit(BLANK)) != ""


def normal(line: Column) -> Column:
    """The line as it is compared. Most have no blanks at their ends, and trimming reads a whole line."""
    blank = reduce(or_, [end for c in BLANK for end in (line.startswith(c), line.endswith(c))])
    return F.lower(F.when(blank, F.btrim(line, F.lit(BLANK))).otherwise(line))


def lines_of(docs: DataFrame) -> DataFrame:
    """``doc_id, text_id, place, line, id, other`` of each line with a word; two hashes of the line."""
    return (docs.select("doc_id", F.xxhash64("text").alias("text_id"),
                        F.posexplode(F.split("text", "\n")).alias("place", "raw"))
            .filter(has_word(F.col("raw")))
            .select("doc_id", "text_id", "place", normal(F.col("raw")).alias("line"))
            .withColumns({"id": F.xxhash64("line"), "other": F.xxhash64(F.lit(1), "line")}))


def rolling(lines: list[str], n: int = SHINGLE, kind=np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all lines, one behind the other, and where each line's begin (and the last end)."""
    full = [x if len(x) >= n else x + PAD * (n - len(x)) for x in lines]
    chars = np.frombuffer("".join(full).encode("utf-32-le", "surrogatepass"), np.uint32).astype(kind, copy=False)
    top = int(np.iinfo(kind).max)
    factor = 0x9E3779B97F4A7C15 & top
    total, size = chars, 1
    for bit in bin(n)[3:]:  # runs of twice as many characters, or one more
        total = total[:-size] * kind(pow(factor, size, top + 1)) + total[size:]
        size *= 2
        if bit == "1":
            total = total[:-1] * kind(factor) + chars[size:]
            size += 1
    sizes = np.array([len(x) for x in full], np.int64)
    ends = np.cumsum(sizes)
    own = np.ones(len(total), bool)  # not those that run into the next line
    for k in range(1, n):
        own[ends[:-1] - k] = False
    return (_mixed if kind is np.uint64 else _mixed32)(total[own]), np.concatenate([[0], np.cumsum(sizes - n + 1)])


def _mixed32(x: np.ndarray) -> np.ndarray:
    """Bit mixer (a bijection of 32-bit numbers)."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    x = (x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return x ^ (x >> np.uint32(16))


def grams(lines: list[str], n: int = SHINGLE) -> list[np.ndarray]:
    """Sorted hashes of the different shingles of each line."""
    found, at = rolling(lines, n)
    for i, j in zip(at[:-1].tolist(), at[1:].tolist()):
        found[i:j].sort()
    new = np.ones(len(found), bool)
    np.not_equal(found[1:], found[:-1], out=new[1:])
    new[at[:-1]] = True
    ends = np.cumsum(new)[at[1:] - 1].tolist()
    found = found[new]
    return [found[i:j] for i, j in zip([0, *ends], ends)]


def similar(a: np.ndarray, b: np.ndarray, pct: int) -> bool:
    """Whether two shingle sets have a Jaccard similarity of at least ``pct`` percent."""
    m, n = len(a), len(b)
    if m * 100 < n * pct or n * 100 < m * pct:
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")  # merges the two runs
    return int(np.count_nonzero(both[1:] == both[:-1])) * (100 + pct) >= (m + n) * pct


def lowest(lines: list[str], count: int) -> np.ndarray:
    """Smallest hash of each line's shingles under each of ``count`` permutations (a row per permutation)."""
    low = np.empty((count, len(lines)), np.uint32)
    others, odds = ((_odd(count, seed) >> np.uint64(16)).astype(np.uint32) for seed in (13, 29))
    odds |= np.uint32(1)
    for start, end in in_parts([len(x) for x in lines], 1 << 17):
        found, at = rolling(lines[start:end], kind=np.uint32)
        turned = np.empty_like(found)
        for k in range(count):
            np.bitwise_xor(found, others[k], out=turned)
            np.multiply(turned, odds[k], out=turned)
            low[k, start:end] = np.minimum.reduceat(turned, at[:-1])
    return low


def band_hashes(low: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per band and line, different bands apart."""
    total = np.arange(1, bands + 1, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
    for part in low.reshape(bands, rows, -1).transpose(1, 0, 2):
        total = _mixed(total ^ part) + np.uint64(1)
    return total.view(np.int64)


def _planes(low: np.ndarray) -> np.ndarray:
    """``PLANES`` bits of each smallest value, 64 values to a signed word: a row per word, bits of one place together."""
    count, m = low.shape
    words = -(-count // 64)
    bits = _mixed(low.astype(np.uint64))
    out = np.zeros((PLANES, words, m), np.uint64)
    for k in range(count):
        for p in range(PLANES):
            out[p, k // 64] |= (bits[k] >> np.uint64(p) & np.uint64(1)) << np.uint64(k % 64)
    return out.reshape(PLANES * words, m).view(np.int64)


def least_equal(count: int, pct: int) -> int:
    """In how many of ``count`` values, by ``PLANES`` bits, a pair at ``pct`` percent agrees but for one in 100,000."""
    same = pct / 100 + (1 - pct / 100) / 2 ** PLANES
    return max(0, int(count * same - 4.3 * (count * same * (1 - same)) ** 0.5))


def _words(count: int) -> list[str]:
    return [f"w{k}" for k in range(PLANES * -(-count // 64))]


def agree(a: str, b: str, count: int, pct: int) -> Column:
    """Whether two rows of ``held`` can be similar: like sizes and enough equal values."""
    names, per = _words(count), -(-count // 64)
    differ = None
    for w in range(per):
        bits = None
        for name in names[w::per]:
            one = F.col(f"{a}.{name}").bitwiseXOR(F.col(f"{b}.{name}"))
            bits = one if bits is None else bits.bitwiseOR(one)
        differ = F.bit_count(bits) if differ is None else differ + F.bit_count(bits)
    m, n = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (m * 100 >= n * pct) & (n * 100 >= m * pct) & (differ <= count - least_equal(count, pct))


def signatures(lines: DataFrame, bands: int, rows: int) -> DataFrame:
    """``id, other, times, bands``: both hashes of a line, how often it stands in a batch, and the 64-bit hashes of its
    bands, one behind the other. A line has a row for each batch that holds it: the hashes need no shuffle of their own."""
    def run(batches):
        for batch in batches:
            ids, other = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "other"))
            order = np.lexsort((other, ids))
            new = np.ones(len(order), bool)
            new[1:] = (np.diff(ids[order]) != 0) | (np.diff(other[order]) != 0)
            first, times = order[new], np.diff(np.append(np.flatnonzero(new), len(order)))
            texts = batch.column("line").take(pa.array(first)).to_pylist()
            made = band_hashes(lowest(texts, bands * rows), bands, rows)
            made, width = made.T.tobytes(), 8 * bands
            made = pa.array([made[i:i + width] for i in range(0, len(made), width)], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(ids[first]), pa.array(other[first]), pa.array(times, pa.int64()),
                                              made], names=["id", "other", "times", "bands"])

    return map_arrow(lines.select("id", "other", "line"), run, "id bigint, other bigint, times bigint, bands binary")


def several(signed: DataFrame) -> DataFrame:
    """``id, times, low, high`` of the lines that stand several times, and of the hashes that different lines have; stored."""
    return stored(signed.groupBy("id").agg(F.sum("times").alias("times"), F.min("other").alias("low"),
                                           F.max("other").alias("high"))
                  .filter("times > 1 or low != high"), "line-several")


def apart(lines: DataFrame, clashes: DataFrame) -> DataFrame:
    """``lines`` with another id where different lines have one id (``clashes``)."""
    return (lines.join(small(clashes.withColumn("clash", F.lit(True))), "id", "left")
            .withColumn("id", F.when(F.col("clash"), F.xxhash64("other", "id")).otherwise(F.col("id"))).drop("clash"))


def signed_lines(docs: DataFrame, bands: int, rows: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Lines, ``id, bands`` of each line and batch, and ``id`` of the lines that stand several times."""
    lines = lines_of(docs)
    signed = stored(signatures(lines, bands, rows), "line-signatures")
    often = several(signed)
    clashes = often.filter("low != high").select("id")
    if clashes.isEmpty():
        return lines, signed.select("id", "bands"), often.select("id")
    clashes = stored(clashes, "line-clashes")
    anew = stored(signatures(apart(lines.join(small(clashes), "id", "left_semi"), clashes), bands, rows), "line-signatures")
    return (apart(lines, clashes), signed.join(small(clashes), "id", "left_anti").union(anew).select("id", "bands"),
            often.filter("low = high").union(several(anew)).select("id"))


def met(buckets: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, ...]:
    """``buckets, ids, least, m`` of the buckets with several ids, in order; each id once. A bucket's chosen line is the one
    whose id is the smallest after an XOR with one of ``HUBS`` numbers."""
    def with_others(buckets, ids):
        if len(ids) < 2:
            return buckets[:0], ids[:0]
        same = buckets[1:] == buckets[:-1]
        shared = np.concatenate([same[:1], same[1:] | same[:-1], same[-1:]])
        return buckets[shared], ids[shared]

    order = np.argsort(buckets)
    buckets, ids = with_others(buckets[order], ids[order])
    order = np.lexsort((ids, buckets))
    buckets, ids = buckets[order], ids[order]
    new = np.ones(len(ids), bool)
    new[1:] = (buckets[1:] != buckets[:-1]) | (ids[1:] != ids[:-1])
    buckets, ids = with_others(buckets[new], ids[new])
    first = np.flatnonzero(np.append(len(ids) > 0, buckets[1:] != buckets[:-1])[:len(ids)])
    m = np.diff(np.append(first, len(ids)))
    turn = _odd(HUBS, 47).view(np.int64)[buckets % HUBS]
    least = np.minimum.reduceat(ids ^ turn, first) ^ turn[first] if len(ids) else ids
    return buckets, ids, np.repeat(least, m), np.repeat(m, m)


def dealt(signed: DataFrame, slots: int) -> DataFrame:
    """``slot, bucket, id``: lines under the hashes of their bands, those of one slot side by side in two arrays, so that
    the shuffle moves few rows. A bucket is in one slot."""
    def pack(buckets, ids):
        slot = ((buckets.view(np.uint64) >> np.uint64(32)) % np.uint64(slots)).astype(np.int32)
        order = np.argsort(slot, kind="stable")
        counts = np.bincount(slot, minlength=slots)
        used = np.flatnonzero(counts)
        offsets = pa.array(np.append(0, np.cumsum(counts[used])), pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), *[pa.ListArray.from_arrays(offsets, pa.array(x[order])) for x in (buckets, ids)]],
            names=["slot", "bucket", "id"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            made = np.frombuffer(b"".join(batch.column("bands").to_pylist()), np.int64)
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            held.append((made, np.repeat(ids, len(made) // max(1, len(ids)))))
            size += len(made)
            if size >= DEALT:
                yield pack(*map(np.concatenate, zip(*held)))
                held, size = [], 0
        if size:
            yield pack(*map(np.concatenate, zip(*held)))

    return map_arrow(signed.select("id", "bands"), run, "slot int, bucket array<bigint>, id array<bigint>")


def bucket_members(signed: DataFrame, bands: int) -> DataFrame:
    """``bucket, id, least, m`` of the lines in buckets with several lines, stored: the bucket's chosen line and its size.

    Nearly every bucket has one line, so a task sorts its buckets as numbers, about ``DEALT`` of them.
    """
    def run(batches):
        parts = [[batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("bucket", "id")] for batch in batches]
        if parts:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, met(*map(np.concatenate, zip(*parts))))),
                                             names=["bucket", "id", "least", "m"])

    tasks = max(8, -(-signed.count() * bands // DEALT))
    return stored(map_arrow(dealt(signed, 16 * tasks).repartition(tasks, "slot").select("bucket", "id"), run,
                            "bucket bigint, id bigint, least bigint, m bigint"), "line-members")


def measured(texts: DataFrame, count: int) -> DataFrame:
    """``id, n, w0.., line``: number of shingles and bits of the smallest values of lines."""
    names = _words(count)

    def run(batches):
        for batch in batches:
            lines = batch.column("line").to_pylist()
            n = [len(g) for start, end in in_parts([len(x) for x in lines], 1 << 18) for g in grams(lines[start:end])]
            planes = _planes(lowest(lines, count))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n, pa.int32()), *map(pa.array, planes),
                                              batch.column("line")], names=["id", "n", *names, "line"])

    return map_arrow(texts.select("id", "line"), run,
                     "id bigint, n int, " + ", ".join(f"{c} bigint" for c in names) + ", line string")


def similar_pairs(pairs: DataFrame, pct: int) -> DataFrame:
    """``a, b`` of the pairs (``a, b`` with their lines ``x, y``) that are similar."""
    def run(batches):
        for batch in batches:
            a, b = (batch.column(c).to_numpy(zero_copy_only=False) for c in "ab")
            x, y = batch.column("x"), batch.column("y")
            keep = np.zeros(len(a), bool)
            sizes = pc.add(pc.utf8_length(x), pc.utf8_length(y)).to_pylist()
            for start, end in in_parts(sizes, 1 << 20):
                ids = np.concatenate([a[start:end], b[start:end]])
                _, first, at = np.unique(ids, return_index=True, return_inverse=True)
                both = x.slice(start, end - start).to_pylist() + y.slice(start, end - start).to_pylist()
                sets = grams([both[i] for i in first])
                n = end - start
                keep[start:end] = [similar(sets[i], sets[j], pct) for i, j in zip(at[:n], at[n:])]
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])

    return map_arrow(pairs.select("a", "b", "x", "y"), run, "a bigint, b bigint")


def _joining(pct: int, count: int):
    """Links within a pair of blocks that join different components."""
    names, per, least = _words(count), -(-count // 64), least_equal(count, pct)

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        ids, block, n, label = (group.column(c).to_numpy() for c in ("id", "block", "n", "label"))
        n = n.astype(np.int64)
        one_block = group.column("low")[0].as_py() == group.column("high")[0].as_py()
        words = np.stack([group.column(c).to_numpy() for c in names]).view(np.uint64).reshape(PLANES, per, -1)
        m = len(ids)
        _, label = np.unique(label, return_inverse=True)
        near = []  # by the columns, many lines at once: for each line the later ones that can be similar
        step = max(1, PAIRS // m)
        for start in range(0, m, step):
            i = np.arange(start, min(m, start + step))[:, None]
            can = (np.arange(m) > i) & (label != label[i]) & (n * 100 >= n[i] * pct) & (n[i] * 100 >= n * pct)
            if not one_block:
                can &= block != block[i]
            x, y = np.nonzero(can)
            x += start
            differ = np.zeros(len(x), np.int64)
            for w in range(per):
                bits = words[0, w, x] ^ words[0, w, y]
                for p in range(1, PLANES):
                    bits |= words[p, w, x] ^ words[p, w, y]
                differ += np.bitwise_count(bits)
            left = differ <= count - least
            x, y = x[left], y[left]
            cut = np.flatnonzero(np.diff(x, prepend=-1))
            near += [(int(x[a]), at) for a, at in zip(cut, np.split(y, cut[1:]))]
        if not near:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        used = np.unique(np.concatenate([np.array([i for i, _ in near]), *[at for _, at in near]]))
        texts = group.column("line").take(pa.array(used)).to_pylist()
        sets = [g for start, end in in_parts([len(x) for x in texts], 1 << 18) for g in grams(texts[start:end])]
        every = np.concatenate(sets)
        kinds = np.sort(every)
        kinds = kinds[np.append(True, kinds[1:] != kinds[:-1])]
        codes = dict(zip(used.tolist(), np.split(np.searchsorted(kinds, every), np.cumsum(n[used])[:-1])))
        flag = np.zeros(len(kinds), np.int32)
        links = []
        for i, at in near:
            at = at[label[at] != label[i]]
            if not len(at):
                continue
            flag[codes[i]] = 1
            starts = np.cumsum(n[at]) - n[at]
            shared = np.add.reduceat(flag[np.concatenate([codes[k] for k in at.tolist()])], starts)
            flag[codes[i]] = 0
            for k in at[shared * (100 + pct) >= (n[at] + n[i]) * pct]:
                if label[k] != label[i]:
                    links.append((ids[i], ids[k]))
                    label[label == label[k]] = label[i]
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return run


def occurrences(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members of the buckets with several lines (``bucket, id, least, m``), these lines measured, and where all lines stand
    that are members or stand several times (``doc_id, text_id, place, id``)."""
    lines, signed, often = signed_lines(docs, bands, rows)
    members = bucket_members(signed, bands)
    wanted = (members.select("id", F.lit(True).alias("member"))
              .union(often.select("id", F.lit(False)))
              .groupBy("id").agg(F.max("member").alias("member")))
    wanted = stored(wanted, "line-wanted")
    found = stored(lines.join(small(wanted, MOST_SENT), "id").select(
        "doc_id", "text_id", "place", "id", F.when(F.col("member"), F.col("line")).alias("line")), "lines")
    texts = found.filter("line is not null").dropDuplicates(["id"]).select("id", "line")
    return members, stored(measured(texts, bands * rows), "line-texts"), found.drop("line")


def classes(members: DataFrame, held: DataFrame, pct: int = PCT, count: int = BANDS * ROWS) -> DataFrame:
    """``node, root``: the component of every line (by id) that is similar to another line."""
    short = held.drop("line")
    pairs = (members.filter("id != least").select(F.col("least").alias("a"), F.col("id").alias("b")).distinct()
             .join(short.alias("x"), F.col("a") == F.col("x.id")).join(short.alias("y"), F.col("b") == F.col("y.id"))
             .filter(agree("x", "y", count, pct)).select("a", "b"))
    pairs = stored(pairs, "line-pairs")

    def line(name: str, text: str) -> DataFrame:
        return held.select(F.col("id").alias(name), F.col("line").alias(text))

    links = stored(similar_pairs(pairs.join(line("a", "x"), "a").join(line("b", "y"), "b"), pct),
                   "line-links", pairs.count())
    found = components(links, links.count())

    # what a bucket still holds in different components, its chosen line aside (that one is compared)
    labelled = (members.filter("m > 2 and id != least")
                .join(found.withColumnRenamed("node", "id"), "id", "left")
                .join(held.select("id", "n"), "id")
                .select("bucket", "id", "n", F.coalesce("root", "id").alias("label")))
    open_ = stored(labelled.groupBy("bucket")
                   .agg(F.min("label").alias("l0"), F.max("label").alias("l1"), F.count("*").alias("k"), F.sum("n").alias("total"))
                   .filter("l0 != l1").select("bucket", "k", F.ceil(F.col("total") / BLOCK).cast("int").alias("blocks")),
                   "line-open")
    few = (labelled.join(small(open_.filter(F.col("k") <= FEW).select("bucket")), "bucket").drop("n")
           .join(short, "id"))
    met = (few.alias("x").join(few.alias("y"), (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.id") < F.col("y.id"))
                               & (F.col("x.label") != F.col("y.label")) & agree("x", "y", count, pct))
           .select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct())
    met = stored(met, "line-pairs")
    met = similar_pairs(met.join(line("a", "x"), "a").join(line("b", "y"), "b"), pct)
    spread = (labelled.join(open_.filter(F.col("k") > FEW), "bucket").select("bucket", "id", "label", "blocks", F.pmod(F.xxhash64("id"), F.col("blocks"))
                                                    .cast("int").alias("block"))
              .select("bucket", "id", "label", "block",
                      F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
              .select("bucket", "id", "label", "block", F.least("block", "other").alias("low"),
                      F.greatest("block", "other").alias("high")))
    on_workers(members.sparkSession)
    late = stored(spread.join(held, "id").groupBy("bucket", "low", "high")
                  .applyInArrow(_joining(pct, count), "a bigint, b bigint").union(met).distinct(), "line-links")
    # the classes so far are edges to their roots
    return found if late.isEmpty() else components(
        found.select(F.col("node").alias("a"), F.col("root").alias("b")).union(late))


def repeats(docs: DataFrame, pct: int = PCT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, text_id, removed``: places (from 0) of the lines that are not the first of their component."""
    members, held, lines = occurrences(docs, bands, rows)
    found = classes(members, held, pct, bands * rows)
    occ = (lines.join(small(found.withColumnRenamed("node", "id"), MOST_SENT), "id", "left")
           .select("doc_id", "text_id", "place", F.coalesce("root", "id").alias("root")))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "place", "text_id")
    first = stored(occ.groupBy("root").agg(F.min(order).alias("first"), F.count("*").alias("k"))
                   .filter("k > 1").select("root", "first"), "line-firsts")
    gone = occ.join(small(first, MOST_SENT // 4), "root").filter(order != F.col("first"))
    return gone.groupBy("doc_id", "text_id").agg(F.array_sort(F.collect_set("place")).alias("removed"))


def few_places(gone: DataFrame) -> DataFrame:
    """``gone`` stored, to be broadcast if it holds at most ``MOST_SENT`` places (counted)."""
    gone = stored(gone, "line-gone")
    n = gone.agg(F.sum(F.size("removed") + F.lit(4))).first()[0] or 0
    return F.broadcast(gone) if n <= MOST_SENT else gone


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the repeated lines; a document that had words and has none left is dropped.

    Same columns; ``n_chars``, if there, is that of the new text.
    """
    gone = few_places(repeats(docs, **options).select(F.col("doc_id").alias("_doc"), F.col("text_id").alias("_text_id"),
                                                      "removed"))
    lines = F.split("text", "\n")
    kept = let(lines, lambda ls: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), "removed"), lambda k: F.get(ls, k)), "\n"))
    new = F.when(F.col("removed").isNull(), F.col("text")).otherwise(kept)
    joined = (docs.withColumn("_row", F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
              .select("_row", "text", "doc_id")
              .join(gone, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.xxhash64("text") == F.col("_text_id")), "left")
              .select("_row", "removed", new.alias("_text"))
              .filter(F.col("removed").isNull() | F.col("_text").rlike(WORD)))
    return joined.select(*[
        F.col("_text").alias("text") if c == "text"
        else F.length("_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
        else F.col("_row").getField(c).alias(c) for c in docs.columns])


# ---------------------------------------------------------------- query

def op9_line_dedup(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    gone = few_places(repeats(docs).withColumnRenamed("doc_id", "d"))
    sizes = docs.select("doc_id", F.xxhash64("text").alias("t"), F.size(F.filter(
        F.split(F.coalesce("text", F.lit("")), "\n"), has_word)).cast("long").alias("n_lines"))
    return (sizes.join(gone, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("t") == F.col("text_id")), "left")
            .select("doc_id", "n_lines", F.coalesce(F.size("removed"), F.lit(0)).cast("long")
                    .alias("n_removed"), F.coalesce("removed", F.array().cast("array<int>"))
                    .alias("removed")))
