"""Token counts by a linear longest-match automaton.

Greedy word pieces: a word takes the longest piece that begins it, then the longest piece that continues
it, and so on; a word that cannot be covered counts as one unknown token. If the bare mark is a piece, it begins a word
that no longer piece begins. The automaton is a trie of
the vocabulary with a failure link at each node. The link stands for the pieces that greedy matching has
settled when no edge fits, and how many those are is computed beforehand, so a word's length in pieces comes
from one pass over its characters, without building a piece and without stepping back.

The vocabulary (a list of pieces, those that begin a word marked) is broadcast after a check of its size.
Counting runs in Arrow batches in the tasks that read the texts; nothing is shuffled.

Defined results: a NULL, empty or blank text has no words and no tokens. Very long words take linear time.
Repeated rows are counted each. Other columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame

from holdfast.llm.common import digest, hold, map_arrow, small_file, table

VOCABULARY = "piece_bpe_32k.model"
BEGINS = "▁"  # marks a piece that begins a word
CACHED = 500_000
_BLANKS = dict.fromkeys(map(ord, "\t\n\x0b\f\r"), " ")
_automata: dict[str, tuple] = {}


class Automaton:
    """Trie with failure links and counts of settled pieces.

    Node 0 begins words, node 1 continues them. ``link[v]`` is the node that goes on after ``v`` when no
    edge fits (-1: the word cannot be covered), ``settled[v]`` the number of pieces settled by that.
    """

    def __init__(self, pieces: list[str]):
        self.edges: list[dict[str, int]] = [{}, {}]
        piece_ends = set()
        for piece in pieces:
            begins = piece.startswith(BEGINS)
            node = 0 if begins else 1
            for char in piece[len(BEGINS):] if begins else piece:
                node = self.edges[node].setdefault(char, len(self.edges))
                if node == len(self.edges):
                    self.edges.append({})
            if node > 1:
                piece_ends.add(node)
        self.link, self.settled = [-1] * len(self.edges), [0] * len(self.edges)
        if BEGINS in pieces:  # the bare mark, then pieces that continue
            self.link[0], self.settled[0] = 1, 1
        level = [0, 1]
        while level:  # breadth first: links of shorter strings are known
            deeper = []
            for parent in level:
                for char, node in self.edges[parent].items():
                    deeper.append(node)
                    if node in piece_ends:
                        self.link[node], self.settled[node] = 1, 1
                        continue
                    at, count = self.link[parent], self.settled[parent]
                    while at >= 0 and char not in self.edges[at]:
                        at, count = self.link[at], count + self.settled[at]
                    if at >= 0:
                        self.link[node], self.settled[node] = self.edges[at][char], count
            level = deeper

    def count(self, word: str) -> int:
        """Pieces of the word; 0 if it cannot be covered."""
        edges, link, settled = self.edges, self.link, self.settled
        node, count = 0, 0
        for char in word:
            while (to := edges[node].get(char)) is None:
                count += settled[node]
                node = link[node]
                if node < 0:
                    return 0
            node = to
        while node != 1:
            count += settled[node]
            node = link[node]
            if node < 0:
                return 0
        return count


def pieces_of(model: bytes) -> list[str]:
    """Ordinary pieces of a sentencepiece model, without control and byte pieces."""
    from sentencepiece import SentencePieceProcessor

    reader = SentencePieceProcessor(model_proto=model)
    return [reader.id_to_piece(i) for i in range(reader.get_piece_size())
            if not (reader.is_control(i) or reader.is_unknown(i) or reader.is_byte(i))]


def _automaton(pieces: list[str], key: str) -> tuple[Automaton, dict[str, int]]:
    """The automaton and its cache of words, kept by the worker process."""
    if key not in _automata:
        _automata[key] = (Automaton(pieces), {})
    return _automata[key]


def words(text: str | None) -> list[str]:
    """Words between ASCII white space."""
    return [w for w in (text or "").translate(_BLANKS).split(" ") if w]


def tally(text: str | None, automaton: Automaton, cache: dict[str, int]) -> tuple[int, int, int, int]:
    """Words, tokens, unknown words and the longest word's tokens of one text."""
    found = words(text)
    try:
        counts = [cache[w] for w in found]
    except KeyError:
        if len(cache) > CACHED:
            cache.clear()
        counts = []
        for w in found:
            n = cache.get(w)
            if n is None:
                n = automaton.count(w)
                if len(w) <= 64 and len(cache) <= CACHED:
                    cache[w] = n
            counts.append(n)
    unknown = counts.count(0)
    return len(counts), sum(counts) + unknown, unknown, max(counts, default=0)


COUNTS = "doc_id bigint, n_words bigint, n_tokens bigint, n_unknown bigint, longest_word bigint"


def token_counts(docs: DataFrame, vocabulary_path: str | None = None) -> DataFrame:
    """One row per document: words, tokens, unknown words, tokens of the longest word."""
    model = small_file(vocabulary_path or public_tokenizers.path(VOCABULARY))
    sent = docs.sparkSession.sparkContext.broadcast(pieces_of(model))
    key = digest(model)

    def count(batches):
        automaton, cache = _automaton(sent.value, key)
        hold(cache)
        for batch in batches:
            rows = [tally(t.as_py(), automaton, cache) for t in batch.column("text")]
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), *[pa.array(c, pa.int64()) for c in columns]],
                names=["doc_id", "n_words", "n_tokens", "n_unknown", "longest_word"])

    return map_arrow(docs.select("doc_id", "text"), count, COUNTS)


# ---------------------------------------------------------------- query

def op4_token_counts(spark, sf_dir) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
