import zlib

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from holdfast.llm import packing as P
from tests.llm.helpers import EDGES, LONG, edge_frame


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(P.VOCABULARY))


def whole(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def check_layout(rows):
    """Sequences are gapless from 0 and at most LENGTH long."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= P.LENGTH
    return len(by)


def check_pieces(rows, texts, tokenizer):
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert set(by) == set(texts)
    for doc, text in texts.items():
        ids = whole(tokenizer, text)
        parts = [ids[k:k + P.LENGTH] for k in range(0, len(ids), P.LENGTH)]
        got = sorted(by[doc], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length, r.ids_crc32) for r in got] == [
            (k, k * P.LENGTH, len(p), zlib.crc32(np.array(p, "<u4").tobytes())) for k, p in enumerate(parts)]


def test_query_equals_whole_text_encoding(spark, sf, tokenizer):
    rows = P.op10_best_fit_packing(spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    check_pieces(rows, texts, tokenizer)
    used = check_layout(rows)
    assert used <= 1.06 * sum(r.length for r in rows) / P.LENGTH + 1


def test_chunks_equal_whole_text(tokenizer):
    chunks = P.Chunks(open(public_tokenizers.path(P.VOCABULARY), "rb").read())
    for text in ("It's we've I'LL d'or", "Straße İstanbul ΑΣ ΣΑΣ e\u0301 \u0301x", "a\x1cb \x1d c\x85d\xa0e\u3000f",
                 "one,two...three!? 12.5% #tag <|endoftext|> x", "日本 語 😀😀 ½ ²", "", "\u2028x\u200by", "İ. ẞ, ŉ. Ÿ! é. ÀÉÎ ĲŒŠŽŸ, Ŀa ſs ıI", LONG):
        assert chunks.encoded(text) == np.array(whole(tokenizer, text)[:-1], "<u4").tobytes(), text


def test_best_fit_and_bounded_space():
    numbers = iter(range(100))
    packer = P.Packer(10, 2, lambda: next(numbers))
    assert packer.place(6) == (0, 0) and packer.place(7) == (1, 0)
    assert packer.place(3) == (1, 7)       # the fullest that takes it, which is full now
    assert packer.place(5) == (2, 0)       # open: 0 with 4 free, 2 with 5 free
    assert packer.place(9) == (3, 0)       # a third open one: itself the fullest, closes
    assert packer.place(1) == (0, 6) and packer.place(5) == (2, 5)
    assert packer.place(10) == (4, 0) and packer.n_open == 1


def test_edges(spark, tokenizer):
    frame = edge_frame(spark)
    rows = P.pack(frame).collect()
    check_layout(rows)
    distinct = {i: t for i, t, *_ in EDGES if i != 6}
    check_pieces([r for r in rows if r.doc_id != 6], distinct, tokenizer)
    assert sum(r.doc_id == 6 for r in rows) == 2
    assert P.pack(edge_frame(spark, [])).count() == 0


def test_many_packers_keep_every_piece(spark):
    frame = spark.createDataFrame([(i, "word " * (i * 7 % 300)) for i in range(400)], "doc_id bigint, text string")
    rows = P.pack(frame, per_packer=4, most_open=3).collect()
    assert sorted(r.doc_id for r in rows) == list(range(400))
    check_layout(rows)
