import random

import public_tokenizers

from holdfast.llm import token_counts as T
from tests.llm.helpers import EDGES, edge_frame


def greedy(word, begin, later):
    """Pieces of a word by trying every length, longest first, the bare mark last; 0 if it cannot be covered."""
    count, at = 0, 0
    while at < len(word):
        pieces = begin if count == 0 else later
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None and (count or "" not in begin):
            return 0
        at, count = end or at, count + 1
    return count


def split(pieces):
    return ({p[1:] for p in pieces if p.startswith(T.BEGINS)}, {p for p in pieces if not p.startswith(T.BEGINS)})


def test_automaton_on_small_vocabularies():
    rng = random.Random(5)
    for _ in range(300):
        pieces = list({("▁" if rng.random() < 0.5 else "")
                       + "".join(rng.choice("abc") for _ in range(rng.randrange(1, 6))) for _ in range(12)})
        automaton, (begin, later) = T.Automaton(pieces), split(pieces)
        for _ in range(40):
            word = "".join(rng.choice("abcd") for _ in range(rng.randrange(1, 14)))
            assert automaton.count(word) == greedy(word, begin, later), (pieces, word)


def test_public_vocabulary_on_documents(spark, sf):
    pieces = T.pieces_of(open(public_tokenizers.path(T.VOCABULARY), "rb").read())
    begin, later = split(pieces)
    rows = {r.doc_id: r for r in T.op4_token_counts(spark, sf).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for i, text in list(texts.items())[::5]:
        counts = [greedy(w, begin, later) for w in text.split()]
        r = rows[i]
        assert (r.n_words, r.n_tokens, r.n_unknown, r.longest_word) == (
            len(counts), sum(counts) + counts.count(0), counts.count(0), max(counts, default=0))


def test_edges(spark):
    rows = T.token_counts(edge_frame(spark)).collect()
    assert len(rows) == len(EDGES)
    by = {r.doc_id: r for r in rows}
    assert all(by[i].n_words == by[i].n_tokens == 0 for i in (2, 3, 4))
    assert by[9].n_words == 1 and by[9].n_tokens > 1 and by[5].n_words == 90_000
    assert T.token_counts(edge_frame(spark, [])).count() == 0
