"""Best-fit packing of token sequences: bounded space, online.

Documents become token ids (a public tokenizer's, then an end id), documents over the sequence length
become pieces of that length, and pieces are packed into sequences. A packer keeps a fixed number of
open sequences. A bitset keyed by free space finds the fullest one that still takes a piece; if there is
none, a new one opens, and beyond the fixed number the fullest closes first.

Tokenizing runs once, inside the tasks that read the texts; only pieces (id, length, checksum), stored in the
shared folder, go on. They are dealt by a hash of document and piece to packers of ``per_packer``
sequences each on average, which sorts no document or copy group into one task, and each packer works in
a fixed order, so a packer that is run again gives the same rows.

Tokenizing: the tokenizer drops white space and never joins characters over it, so ids of a text are the ids of
its blank-separated chunks in turn. Texts are split and their chunks numbered as Arrow columns; each different chunk is
looked up once for some megabytes of text, and the ids are gathered by number. Each worker keeps the ids of twice
``CACHED`` words (chunks in small letters without the marks behind them) at most.

Defined results: a NULL or empty text is the end id alone. Repeated rows are packed each. An empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import digest, hold, in_parts, map_arrow, on_workers, small_file, stored, table

LENGTH = 2048
OPEN = 256
PER_PACKER = 16384
CACHED = 400_000
TOGETHER = 500  # words that are encoded as one text
MOST_BYTES = 8 << 20  # of text that are worked on at once, or one longer text
VOCABULARY = "word_bpe_49k.json"

#: A chunk of Latin letters and marks after them: the tokenizer splits there as well. (Not with U+0130, whose
#: small form ends in a mark.)
_WORD_MARKS = ("^(?P<word>[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+)"
               "(?P<marks>[.,;:!?#*$%&|]*)$")
_chunks: dict[str, Chunks] = {}


class Chunks(dict):
    """Ids of words as little-endian unsigned 32-bit integers, made when they are first asked for.

    Holds two generations of at most ``CACHED`` words: a full one grows old, and what is asked for again
    moves to the new one.
    """

    def __init__(self, vocabulary: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_str(vocabulary.decode())
        self.old: dict[str, bytes] = {}

    def clear(self) -> None:
        super().clear()
        self.old = {}

    def _coded(self, words: list[str], latin: list[bool]) -> list[bytes]:
        """Ids of words that are not held. Small Latin words are encoded many in one text, as the tokenizer makes each
        a word of its own; others alone."""
        out: list[bytes | None] = [None] * len(words)
        plain = [k for k, yes in enumerate(latin) if yes]
        parts = [plain[a:a + TOGETHER] for a in range(0, len(plain), TOGETHER)]
        coded = self.tokenizer.encode_batch([" ".join([words[k] for k in part]) for part in parts],
                                            add_special_tokens=False)
        for part, found in zip(parts, coded):
            raw = np.array(found.ids, "<u4").tobytes()
            at = (4 * np.searchsorted(found.word_ids, np.arange(len(part) + 1))).tolist()
            for k, a, b in zip(part, at, at[1:]):
                out[k] = raw[a:b]
        others = [k for k, yes in enumerate(latin) if not yes]
        coded = self.tokenizer.encode_batch_fast([words[k] for k in others], add_special_tokens=False)
        for k, found in zip(others, coded):
            out[k] = struct.pack(f"<{len(found.ids)}I", *found.ids)
        return out

    def of(self, words: list[str], latin: list[bool]) -> list[bytes]:
        """Ids of different words; those that are not held are encoded together."""
        found = list(map(self.get, words))
        held = [k for k, ids in enumerate(found) if ids is None]
        for k in held:
            found[k] = self.old.get(words[k])
        missing = [k for k in held if found[k] is None]
        for k, ids in zip(missing, self._coded([words[k] for k in missing], [latin[k] for k in missing])):
            found[k] = ids
        for k in held:
            if len(words[k]) <= 64:
                if len(self) >= CACHED:
                    full = dict(self)
                    self.clear()
                    self.old = full
                self[words[k]] = found[k]
        return found

    def of_chunks(self, chunks: pa.Array) -> list[bytes]:
        """Ids of different chunks: those of the word in small letters, then those of the marks behind it."""
        split = pc.extract_regex(chunks, _WORD_MARKS)
        latin = split.is_valid()
        word = pc.if_else(latin, pc.utf8_lower(split.field("word")), chunks).dictionary_encode()
        marks = pc.if_else(latin, split.field("marks"), "").dictionary_encode()
        texts = word.dictionary.to_numpy(zero_copy_only=False).tolist()
        is_latin = np.zeros(len(texts), bool)
        at = word.indices.to_numpy()
        is_latin[at] = latin.to_numpy(zero_copy_only=False)
        by_word = self.of(texts, is_latin.tolist())
        tails = marks.dictionary.to_pylist()
        by_marks = self.of(tails, [False] * len(tails))
        return [by_word[k] + by_marks[m] for k, m in zip(at.tolist(), marks.indices.to_numpy().tolist())]

    def ids_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts (no NULL), one text behind the other, and how many each has."""
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        own = self.of_chunks(coded.dictionary)
        size = np.fromiter(map(len, own), np.int64, len(own)) // 4
        start = np.cumsum(size) - size
        ids = np.frombuffer(b"".join(own), "<u4")
        chunk = coded.indices.to_numpy()
        n = size[chunk]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        out = ids[np.repeat(start[chunk] - (ends - n), n) + np.arange(total)] if total else ids[:0]
        before = np.concatenate([[0], ends])
        at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        return out, np.diff(before[at])

    def encoded(self, text: str | None) -> bytes:
        """Ids of a whole text."""
        return self.ids_of(pa.array([text or ""], pa.large_string()))[0].tobytes()


def chunks_of(vocabulary: bytes, key: str) -> Chunks:
    """Tokenizer and cache, kept by the worker process."""
    if key not in _chunks:
        _chunks[key] = Chunks(vocabulary)
    hold(_chunks[key])
    return _chunks[key]


def _pieces(docs: pa.Array, ids: np.ndarray, n: np.ndarray, length: int, end: int) -> pa.RecordBatch:
    """The pieces of some documents: ``ids`` holds those of all, ``n`` of each."""
    ends = np.cumsum(n)
    whole = np.insert(ids, ends, end)  # the end id behind each document
    n = n + 1
    count = -(-n // length)
    doc = np.repeat(np.arange(len(n)), count)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = piece * length
    size = np.minimum(n[doc] - start, length)
    at = (np.cumsum(n) - n)[doc] + start
    held = memoryview(whole.astype("<u4", copy=False)).cast("B")
    sums = [zlib.crc32(held[4 * a:4 * (a + s)]) for a, s in zip(at.tolist(), size.tolist())]
    return pa.RecordBatch.from_arrays(
        [docs.take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()),
         pa.array(sums, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(docs: DataFrame, vocabulary: bytes, length: int = LENGTH, end: int = 0) -> DataFrame:
    """Documents cut into pieces of at most ``length`` tokens; the end id belongs to the last one."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    key = digest(vocabulary)

    def cut(batches):
        chunks = chunks_of(sent.value, key)
        for batch in batches:
            texts = batch.column("text").cast(pa.large_string()).fill_null("")
            for at, to in in_parts(pc.binary_length(texts).to_pylist(), MOST_BYTES):
                ids, n = chunks.ids_of(texts.slice(at, to - at))
                yield _pieces(batch.column("doc_id").cast(pa.int64()).slice(at, to - at), ids, n, length, end)

    return map_arrow(docs.select("doc_id", "text"), cut, PIECES)


class Packer:
    """Online best fit with at most ``most_open`` open sequences of ``length``."""

    def __init__(self, length: int, most_open: int, number):
        self.length, self.most_open, self.number = length, most_open, number
        self.bits, self.n_open = 0, 0
        self.by_free: dict[int, list[int]] = defaultdict(list)

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        taken = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.n_open -= 1
        return taken

    def place(self, size: int) -> tuple[int, int]:
        """Sequence and offset for a piece of ``size`` tokens."""
        fits = self.bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            bin_id = self._take(free)
        else:
            free, bin_id = self.length, self.number()
        left = free - size
        if left:
            if self.n_open == self.most_open:
                fullest = (self.bits & -self.bits).bit_length() - 1
                if fullest >= left:  # the piece's own sequence is the fullest and closes
                    return bin_id, self.length - free
                self._take(fullest)
            self.by_free[left].append(bin_id)
            self.bits |= 1 << left
            self.n_open += 1
        return bin_id, self.length - free


PACKED = f"{PIECES}, sequence_id bigint, offset bigint"


def packed(found: DataFrame, packers: int, length: int = LENGTH, most_open: int = OPEN) -> DataFrame:
    """Pieces with their sequence and place, packed by ``packers`` tasks."""
    on_workers(found.sparkSession)

    def pack(batches):
        from pyspark import TaskContext

        base, count = TaskContext.get().partitionId() << 40, iter(range(1 << 40))
        packer = Packer(length, most_open, lambda: base + next(count))
        for batch in batches:
            places = [packer.place(n) for n in batch.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([p[0] for p in places], pa.int64()),
                 pa.array([p[1] for p in places], pa.int64())],
                names=[*batch.schema.names, "sequence_id", "offset"])

    order = F.xxhash64("doc_id", "piece")
    names = [c.split()[0] for c in PIECES.split(", ")]
    dealt = (found.select(*names).repartition(packers, order)
             .sortWithinPartitions(order, *names))
    return map_arrow(dealt, pack, PACKED)


def pack(docs: DataFrame, vocabulary_path: str | None = None, length: int = LENGTH,
         most_open: int = OPEN, per_packer: int = PER_PACKER) -> DataFrame:
    """Documents to packed pieces. ``most_open`` sequences stay open; a packer fills about
    ``per_packer`` sequences, so their number follows the input."""
    vocabulary = small_file(vocabulary_path or public_tokenizers.path(VOCABULARY))
    found = stored(pieces(docs, vocabulary, length), "pieces")
    tokens = found.agg(F.sum("length")).first()[0] or 0
    return packed(found, max(1, -(-tokens // (length * per_packer))), length, most_open)


# ---------------------------------------------------------------- query

def op10_best_fit_packing(spark, sf_dir) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
