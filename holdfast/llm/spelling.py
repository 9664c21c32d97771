"""Spelling variant grouping: words one edit apart, by bitsets per position and letter.

1. Words are counted inside the tasks that read the texts (runs of letters as Arrow columns), then over all documents.
2. Words are dealt so that near words meet. Take n, the shorter one's length, and k, half of it: if the edit lies behind the
   first k letters these are equal, else the last n - k are. So a word is filed under its first k and its last n - k letters,
   for n its length and one less: four rows a word. A pair counts under its beginning if that is equal, else under its end,
   so it counts once.
3. The words of a file are sorted by falling number and numbered in slices of 64. For each slice, position and letter a 64-bit
   word tells which words have the letter there. For every word of the file and every slice of it, recurrences over the
   positions carry sets: no error so far, one replaced letter, one letter more in the word, one less (shifted by a position).
   The lowest bit of the final set is the near word of largest n. All words of many files go through each step at once.
4. Files of more than ``BLOCK`` words are cut into blocks, each met with each block of the file, so that a task holds two.
   A word gives one row a slice that has near words, which are added up.
5. Forms point to words at least twice as frequent, so there are no rings; roots are found by doubling the pointers.

Comparisons grow with words times slices of 64 in their files, not with pairs, and no pair leaves a task.

Defined results: NULL or empty texts have no words; a row without doc_id counts with an empty one. Repeated rows count each.
Other columns are ignored. An empty table gives no rows. A word may be of any length.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import in_parts, map_arrow, small, stored, table

LEAST_LENGTH, LEAST_TIMES = 5, 3
DAMAGED = 97
RATIO = 2
BLOCK = 8192
ROWS = 1 << 17  # pairs of word and slice that are worked on at once
CELLS = 1 << 24  # letters that are held as one matrix
MOST_BYTES = 8 << 20
CRC_BYTES = 64  # words of up to so many bytes have their checksum by table

COUNTED = "word string, n bigint"


# ---------------------------------------------------------------- words

def _crc_table() -> np.ndarray:
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & 1, (x >> 1) ^ np.uint32(0xEDB88320), x >> 1)
    return x


_CRC = _crc_table()


def _checksums(doc_ids: list[str], docs: np.ndarray, words: list[bytes], word: np.ndarray) -> np.ndarray:
    """crc32 of ``doc_id:word`` for each pair. The sum of a joined text is that of its end, XOR that of its beginning moved
    on by as many zero bytes as the end is long."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    own = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    moved = np.empty((CRC_BYTES + 1, len(doc_ids)), np.uint32)
    moved[0] = [zlib.crc32(f"{d}:".encode()) for d in doc_ids]
    for k in range(CRC_BYTES):
        moved[k + 1] = _CRC[moved[k] & 255] ^ (moved[k] >> np.uint32(8))
    n = size[word]
    out = moved[np.minimum(n, CRC_BYTES), docs] ^ own[word]
    for k in np.flatnonzero(n > CRC_BYTES):
        out[k] = zlib.crc32(f"{doc_ids[docs[k]]}:".encode() + words[word[k]])
    return out


def _counts(docs: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    """Words of some texts, damaged as stated, and how often they stand there."""
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), "[^A-Za-zÀ-ÿ]+")
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    word = coded.indices.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    pair, times = np.unique(doc * max(1, len(words)) + word, return_counts=True)
    doc, word = np.divmod(pair, max(1, len(words)))
    sums = _checksums(docs.cast(pa.string()).fill_null("").to_pylist(), doc, [w.encode() for w in words], word)
    hit = sums % DAMAGED == 0
    n = np.bincount(word[~hit], times[~hit], len(words)).astype(np.int64)
    found = {w: c for w, c in zip(words, n.tolist()) if c}
    for w, h, c in zip(word[hit].tolist(), sums[hit].tolist(), times[hit].tolist()):
        text = words[w]
        if text:
            at = h % len(text)
            text = text[:at] + text[at + 1:]
            found[text] = found.get(text, 0) + c
    kept = [(w, c) for w, c in found.items() if len(w) >= LEAST_LENGTH]
    return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([c for _, c in kept], pa.int64())],
                                      names=["word", "n"])


def vocabulary(docs: DataFrame, least_times: int = LEAST_TIMES) -> DataFrame:
    """``word, n`` of the words that are long and frequent enough."""
    def count(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.large_string()).fill_null("")
            for a, b in in_parts(pc.binary_length(texts).to_pylist(), MOST_BYTES):
                yield _counts(batch.column("doc_id").slice(a, b - a), texts.slice(a, b - a))

    return (map_arrow(docs.select("doc_id", "text"), count, COUNTED).groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= least_times))


# ---------------------------------------------------------------- near words

def filed(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows ``kind, size, file, low, high, role, word, n``: each word in its files, by pairs of blocks.

    size: the shorter word's length. A row is to be found (role 1), looks for others (2), or both (3).
    """
    length = F.length("word")
    k = (F.col("size") / 2).cast("int")
    rows = (words.select("word", "n", F.explode(F.array(length, length - 1)).alias("size"))
            .select("word", "n", "size", F.posexplode(F.array(
                F.left("word", k), F.right("word", F.col("size") - k))).alias("kind", "part"))
            .select("kind", "size", F.xxhash64("part").alias("file"), "word", "n"))
    hot = stored(rows.groupBy("kind", "size", "file").agg(F.count("*").alias("m")).filter(F.col("m") > block)
                 .withColumn("blocks", F.ceil(F.col("m") / block).cast("int")).drop("m"), "hot-files")
    rows = rows.join(small(hot), ["kind", "size", "file"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("word", F.lit(9)), F.col("blocks")).cast("int")
    rows = rows.select("kind", "size", "file", "word", "n", own.alias("own"),
                       F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    same = F.col("own") == F.col("other")
    sides = F.when(same, F.array(F.struct(F.col("own").alias("low"), F.col("own").alias("high"), F.lit(3).alias("role")))
                   ).otherwise(F.array(F.struct(F.col("own").alias("low"), F.col("other").alias("high"), F.lit(1).alias("role")),
                                       F.struct(F.col("other").alias("low"), F.col("own").alias("high"), F.lit(2).alias("role"))))
    return (rows.select("kind", "size", "file", "word", "n", F.explode(sides).alias("s"))
            .select("kind", "size", "file", "s.low", "s.high", "s.role", "word", "n"))


GROUP = ["kind", "size", "file", "low", "high"]


class Slices:
    """Bitsets per slice, position and letter of the words that can be found."""

    def __init__(self, letters: np.ndarray, part: np.ndarray, bit: np.ndarray):
        self.keys, self.bits = [], []
        one = np.uint64(1) << bit.astype(np.uint64)
        for p in range(letters.shape[1]):
            key = part * 256 + letters[:, p]  # parts do not fall: equal keys of a part may still lie apart
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            self.keys.append(key[first])
            self.bits.append(np.bitwise_or.reduceat(one[order], first))

    def at(self, p: int, part: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The words of each slice that have the letter at position p."""
        if not 0 <= p < len(self.keys):
            return np.zeros(len(part), np.uint64)
        key = part * 256 + letter
        k = np.minimum(np.searchsorted(self.keys[p], key), len(self.keys[p]) - 1)
        return np.where(self.keys[p][k] == key, self.bits[p][k], np.uint64(0))


def _near(slices: Slices, part: np.ndarray, same: np.ndarray, longer: np.ndarray, query: np.ndarray, is_longer: np.ndarray,
          size: int, kind: int) -> np.ndarray:
    """For each query and slice the words one edit away. ``same`` and ``longer`` are the slice's words of ``size`` letters and
    of one more; a query has ``size`` letters, or one more where ``is_longer``."""
    exact = same | longer
    replaced, more, less = (np.zeros(len(part), np.uint64) for _ in range(3))
    begins = exact
    for i in range(size):
        letter = query[:, i].astype(np.int64)
        here, before, behind = (slices.at(p, part, letter) for p in (i, i - 1, i + 1))
        more = (more & before) | exact  # the query's letter i is one too many
        less = (less & behind) | (exact & behind)  # the word's letter i is
        replaced = (replaced & here) | (exact & ~here)
        exact = exact & here
        if i + 1 == size // 2:
            begins = exact
    found = np.where(is_longer, np.uint64(0), (replaced & same) | ((less | exact) & longer))
    last = slices.at(size - 1, part, query[:, size].astype(np.int64))
    found |= np.where(is_longer, ((more & last) | exact) & same, np.uint64(0))
    return found & (begins if kind == 0 else ~begins)


MET = "word string, n_near bigint, form_n bigint, form string"


def _matrix(words: list[str], width: int) -> np.ndarray:
    raw = b"".join(w.encode("latin-1").ljust(width, b"\0") for w in words)
    return np.frombuffer(raw, np.uint8).reshape(len(words), width)


def _met(kind: int, size: int, group: np.ndarray, role: np.ndarray, words: np.ndarray, n: np.ndarray) -> list[tuple]:
    """``word, n_near, form_n, form`` per word and slice with near words, for files of one kind and size.

    Rows are sorted by group, falling n and word.
    """
    target, asks = np.flatnonzero(role & 1), np.flatnonzero(role & 2)
    if not len(target) or not len(asks):
        return []
    new = np.concatenate([[True], group[target][1:] != group[target][:-1]])
    first = np.flatnonzero(new)
    place = np.arange(len(target)) - np.repeat(first, np.diff(np.append(first, len(target))))
    bit = place % 64
    part = np.cumsum(bit == 0) - 1  # one number per slice
    starts = np.flatnonzero(bit == 0)
    own = group[target][starts]
    length = np.fromiter(map(len, words), np.int64, len(words))
    letters = _matrix(words.tolist(), size + 1)
    slices = Slices(letters[target], part, bit)
    one = np.uint64(1) << bit.astype(np.uint64)
    of = lambda which: np.bitwise_or.reduceat(np.where(which, one, np.uint64(0)), starts)
    same, longer = of(length[target] == size), of(length[target] == size + 1)
    low, high = np.searchsorted(own, group[asks]), np.searchsorted(own, group[asks], "right")
    out = []
    for a, b in in_parts((high - low).tolist(), ROWS):
        count = high[a:b] - low[a:b]
        at = np.repeat(asks[a:b], count)
        ends = np.cumsum(count)
        s = np.arange(len(at)) + np.repeat(low[a:b] - (ends - count), count)
        found = _near(slices, s, same[s], longer[s], letters[at], length[at] > size, size, kind)
        hit = np.flatnonzero(found)
        if len(hit):
            bits, s, at = found[hit], s[hit], at[hit]
            best = target[starts[s] + np.bitwise_count((bits & -bits) - np.uint64(1))]
            out += zip(words[at].tolist(), np.bitwise_count(bits).tolist(), n[best].tolist(), words[best].tolist())
    return out


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """``word, n_near, form_n, form`` of the words that have near words: how many, and the near word of largest n."""
    rows = filed(words, block)
    parts = max(1, int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = (rows.repartition(parts, *GROUP).sortWithinPartitions(*GROUP, F.desc("n"), "word")
             .select(*GROUP, "role", "word", "n"))

    def meet(batches):
        held, cells = [], 0

        def worked(rows: pa.Table):
            kind, size, role, n = (rows.column(c).to_numpy() for c in ("kind", "size", "role", "n"))
            keys = [rows.column(c).to_numpy() for c in GROUP]
            new = np.zeros(len(rows), bool)
            new[0] = True
            for k in keys:
                new[1:] |= k[1:] != k[:-1]
            group = np.cumsum(new)
            words = rows.column("word").to_numpy()
            cut = np.flatnonzero(np.concatenate([[True], (kind[1:] != kind[:-1]) | (size[1:] != size[:-1]), [True]]))
            out = []
            for a, b in zip(cut, cut[1:]):
                out += _met(int(kind[a]), int(size[a]), group[a:b], role[a:b], words[a:b], n[a:b])
            if out:
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                                 names=["word", "n_near", "form_n", "form"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            cells += pc.sum(pc.binary_length(batch.column("word"))).as_py() + 64 * batch.num_rows
            if cells < CELLS:
                continue
            rows = pa.Table.from_batches(held)
            new = np.zeros(len(rows), bool)
            for c in GROUP:
                k = rows.column(c).to_numpy()
                new[1:] |= k[1:] != k[:-1]
            last = int(np.flatnonzero(new)[-1]) if new.any() else 0  # the last group may go on
            if last:
                yield from worked(rows.slice(0, last))
                held, cells = rows.slice(last).to_batches(), 0
        if held:
            yield from worked(pa.Table.from_batches(held))

    met = map_arrow(dealt, meet, MET)
    best = F.min(F.struct((-F.col("form_n")).alias("m"), "form")).alias("best")
    return (met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
            .select("word", "n_near", (-F.col("best.m")).alias("form_n"), F.col("best.form").alias("form")))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for the words of ``forms`` (``word, form``, without rings): the last form reached."""
    now = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = small(now.select(F.col("word").alias("root"), F.col("root").alias("next")))
        moved = stored(now.join(onward, "root", "left")
                       .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                       "forms")
        now = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            return now


def variants(docs: DataFrame, least_times: int = LEAST_TIMES, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``."""
    words = stored(vocabulary(docs, least_times), "words")
    near = stored(near_words(words, block), "near-words")
    both = words.join(near, "word", "left").withColumn("has", F.coalesce(F.col("form_n") >= ratio * F.col("n"), F.lit(False)))
    both = stored(both.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                              F.when(F.col("has"), F.col("form")).alias("form"),
                              F.when(F.col("has"), F.col("form_n")).alias("form_n")), "word-forms")
    last = roots(both.filter("form is not null"))
    return (both.join(last, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


# ---------------------------------------------------------------- query

def op13_spelling_variants(spark, sf_dir) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))
