import random

import public_tokenizers

from holdfast.llm import token_counts as T


def greedy(word, pieces):
    """Pieces of the marked word by trying every length, longest first, the bare mark too; 0 if it cannot be covered."""
    text, count, at = T.BEGINS + word, 0, 0
    while at < len(text):
        end = next((e for e in range(len(text), at, -1) if text[at:e] in pieces
                    and text[at:e].startswith(T.BEGINS) == (at == 0)), None)
        if end is None:
            return 0
        at, count = end, count + 1
    return count


def test_bare_mark_on_small_vocabularies():
    rng = random.Random(7)
    for _ in range(300):
        pieces = {("▁" if rng.random() < 0.4 else "") + "".join(rng.choice("abc") for _ in range(rng.randrange(1, 6)))
                  for _ in range(12)} | ({"▁"} if rng.random() < 0.7 else set())
        automaton = T.Automaton(sorted(pieces))
        for _ in range(40):
            word = "".join(rng.choice("abcd") for _ in range(rng.randrange(1, 14)))
            assert automaton.count(word) == greedy(word, pieces), (pieces, word)


def test_numbers_and_accents_are_covered(spark, sf):
    pieces = set(T.pieces_of(open(public_tokenizers.path(T.VOCABULARY), "rb").read()))
    automaton = T.Automaton(sorted(pieces))
    assert automaton.count("2024") == 5 and automaton.count("4" * 16) == 17
    rows = {r.doc_id: r for r in T.op4_token_counts(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect()[::10]:
        counts = [greedy(w, pieces) for w in T.words(r.text)]
        got = rows[r.doc_id]
        assert (got.n_words, got.n_tokens, got.n_unknown, got.longest_word) == (
            len(counts), sum(counts) + counts.count(0), counts.count(0), max(counts, default=0))
