import hashlib
import random
import re

import pytest

from holdfast.llm import pii
from tests.llm.helpers import EDGES, edge_frame

TEXTS = [
    "mail a.b+c@d-e.org, x@y, @z.com a@b.c@d.e and me@host.co.uk.",
    "ip 10.0.0.1 1.2.3.4.5 999.1.1.1 1.2.3 256.1.1.1 001.002.003.004 1.2.3.4.5.6.7.8",
    "card 4111 1111 1111 1111 or 4111-1111-1111-1112, 0000000000000000 and 4111  1111",
    "call +1 (555) 555-0100 or +49 30 123456. +1 ((((( +12 3 +1234567890123456789",
    "", "+", "@", "1.1.1.1" * 50, "a" * 5000 + "@" + "b" * 5000 + ".c", "9" * 5000,
    "tel +1.555.010.0199 mail:q@w.ee ip:8.8.8.8 4012888888881881",
]
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def by_hand(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = (kind == "email" or (kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")))
                    or (kind == "card" and 14 <= len(digits) <= 19 and luhn(digits))
                    or (kind == "phone" and 10 <= len(digits) <= 15))
            if good:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans_match_the_plain_expressions(text):
    assert [s[:3] for s in pii.find(text) if s[0] in pii.BASE] == by_hand(text)


def test_base_spans_on_random_text():
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice("a.@1+- 90(x\n2") for _ in range(rng.randrange(60)))
        assert [s[:3] for s in pii.find(text) if s[0] in pii.BASE] == by_hand(text), text


def test_checksums():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("GB82 WEST 1234 5698 7654 32") and not pii.mod97("GB82 WEST 1234 5698 7654 33")
    assert pii.verhoeff("2363") and not pii.verhoeff("2364")


def test_context_moves_the_score():
    kinds = lambda t: [s[0] for s in pii.find(t)]
    assert kinds("Her SSN is 123-45-6789.") == ["ssn"] and kinds("Part order 123-45-6789.") == []
    assert kinds("pay to GB82 WEST 1234 5698 7654 32 now") == ["iban"]
    plain, near = (pii.find(t)[0][3] for t in ("see 10.1.2.3 ok", "server 10.1.2.3 ok"))
    assert near > plain
    text = "mail a@b.cc now"
    assert pii.masked(text, pii.find(text)) == "mail <email> now"


def test_spans_survive_edges(spark):
    rows = pii.spans(edge_frame(spark)).collect()
    assert len(rows) == len(EDGES) and all(r.masked is not None for r in rows)
    assert pii.spans(edge_frame(spark, [])).count() == 0


def test_query_digests(spark, sf):
    rows = pii.op3_pii_spans(spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        want = by_hand(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(
            sum(s[0] == k for s in want) for k in pii.BASE)
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))


def test_context_words_are_whole_and_the_nearest_decides():
    kinds = lambda t: [k for k, *_ in pii.find(t)]
    assert "ssn" in kinds("our partner: social 123-45-6789") and "ssn" in kinds("security border 123-45-6789")
    score = {t: pii.find(t)[0][3] for t in ("hotel +49 170 1234567", "lobby +49 170 1234567", "tel +49 170 1234567")}
    assert score["hotel +49 170 1234567"] == score["lobby +49 170 1234567"] < score["tel +49 170 1234567"]
    cut = "hotel" + " " * 37 + "+49 170 1234567"  # the window begins inside the word
    assert pii.find(cut)[0][3] == score["lobby +49 170 1234567"]
