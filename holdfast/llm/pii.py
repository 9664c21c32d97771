"""Personal data: expressions propose spans, checksums confirm them, words nearby adjust the score.

The spans of the base kinds (email, ip, card, phone) are found leftmost and non-overlapping per kind,
and are always part of the result. The method adds the kinds ``iban`` (mod 97), ``ssn`` and
``aadhaar`` (Verhoeff), which count only when confirmed and, for ``ssn``, when their score reaches
``min_score``. Every span carries a score: a base by kind, raised by a context word within
``near`` characters or lowered by a word that speaks against it; words are whole, and the nearest one decides.

Each text is scanned in linear time (possessive expressions and starts fixed at run beginnings), in
Arrow batches inside the tasks; nothing is shuffled.

Defined results: a NULL text is an empty one and has no spans. Repeated rows give repeated results.
Columns of the input with other names are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from holdfast.llm.common import map_arrow, table

KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "aadhaar")
BASE = KINDS[:4]
#: Base score of a confirmed span, and words nearby that raise or lower it.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.4, "aadhaar": 0.5}
FOR = {
    "email": ("mail", "email", "contact", "write"), "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "payment"), "phone": ("phone", "telephone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "account", "bank"), "ssn": ("ssn", "social", "security"),
    "aadhaar": ("aadhaar", "uid"),
}
AGAINST = {
    "email": ("example",), "ip": ("version", "release"), "card": ("order", "invoice", "serial"),
    "phone": ("order", "version"), "iban": ("order",), "ssn": ("order", "part", "serial"),
    "aadhaar": ("order", "serial"),
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++((?:\.[0-9]++){3})")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
#: Length of an account number by country; others end at any group.
_IBAN_LENGTHS = {
    code: int(size) for size, codes in (
        ("15", "NO"), ("16", "BE"), ("18", "DK FI FO GL NL FK"), ("19", "MK SI"), ("20", "AT BA EE KZ LT LU XK MN"),
        ("21", "CH HR LI LV"), ("22", "BG BH CR DE GB GE IE ME RS VA"), ("23", "AE GI IL IQ OM TL SO"),
        ("24", "AD CZ ES MD PK RO SA SE SK TN VG"), ("25", "LY PT ST"), ("26", "IS TR"),
        ("27", "BI DJ FR GR IT MC MR SM"), ("28", "AL AZ BY CY DO GT HU LB NI PL SV"), ("29", "BR EG PS QA UA"),
        ("30", "JO KW MU YE"), ("31", "MT SC"), ("32", "LC"), ("33", "RU")) for code in codes.split()}
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_AADHAAR = re.compile(r"(?<![0-9+-])[2-9][0-9]{3}\x20[0-9]{4}\x20[0-9]{4}(?![\x20-]?[0-9])")
_DIGITS = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    """Mod-10 check of a string of digits."""
    total = sum(map(int, digits[-1::-2]))
    return (total + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])) % 10 == 0


def mod97(iban: str) -> bool:
    """Check of an account number: country and check digits go last, letters count from 10."""
    text = iban.replace(" ", "")
    return 15 <= len(text) <= 34 and int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def verhoeff(digits: str) -> bool:
    """Check by the dihedral group of order 10, tables made from its rule."""
    def times(a: int, b: int) -> int:
        if a < 5:
            return (a + b) % 5 + (0 if b < 5 else 5) if b < 5 else 5 + (a + b - 5) % 5
        return 5 + (a - 5 - b) % 5 if b < 5 else (a - b) % 5

    shift = (1, 5, 7, 6, 2, 8, 3, 0, 9, 4)
    check = 0
    for i, d in enumerate(reversed(digits)):
        value = int(d)
        for _ in range(i % 8):
            value = shift[value]
        check = times(check, value)
    return check == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        if at >= free and (m := _DOMAIN.match(text, at + 1)):
            start = at
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                yield start, m.end()
                free = m.end()
        # a run of local characters before the next sign ends at this one, so scans never overlap
        free = max(free, at + 1)
        at = text.find("@", at + 1)


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Account numbers; what follows one, over a blank, may look like its next group, so ends are tried, longest first."""
    m = _IBAN.search(text)
    while m:
        size, end = _IBAN_LENGTHS.get(m[0][:2]), m.end()
        while end > m.start():
            own = text[m.start():end]
            if (size is None or len(own.replace(" ", "")) == size) and mod97(own):
                break
            end = max(text.rfind(" ", m.start(), end), m.start())
        if end > m.start():
            yield m.start(), end
        # at most 64 characters are read again
        m = _IBAN.search(text, end if end > m.start() else m.start() + 1)


def _octet(part: str) -> bool:
    return len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255


def _plain(kind: str, text: str) -> Iterator[tuple[int, int]]:
    if kind == "email":
        yield from _emails(text)
    elif kind == "ip":
        yield from (m.span() for m in _IP.finditer(text) if all(map(_octet, m[0].split("."))))
    elif kind == "card":
        for m in _CARD.finditer(text):
            digits = _DIGITS.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield m.span()
    elif kind == "phone":
        yield from (m.span() for m in _PHONE.finditer(text) if 10 <= len(_DIGITS.sub("", m[0])) <= 15)
    elif kind == "iban":
        yield from _ibans(text)
    elif kind == "ssn":
        yield from (m.span() for m in _SSN.finditer(text))
    else:
        yield from (m.span() for m in _AADHAAR.finditer(text) if verhoeff(m[0].replace(" ", "")))


def _whole(words: Iterable[str]) -> re.Pattern | None:
    """Any of the words, whole, also with an s."""
    words = sorted(words, key=len, reverse=True)
    return re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, words))})s?(?!\w)") if words else None


_FOR, _AGAINST = ({kind: _whole(words.get(kind, ())) for kind in KINDS} for words in (FOR, AGAINST))


def _distance(words: re.Pattern | None, before: str, after: str, near: int) -> int | None:
    """How far the nearest of the words begins or ends, within ``near``. Both texts have one character more than that, which
    tells whether a word at their far end is whole."""
    if words is None:
        return None
    found = [len(before) - m.end() for m in words.finditer(before) if len(before) - m.start() <= near]
    found += [m.start() for m in words.finditer(after) if m.end() <= near]
    return min(found, default=None)


def find(text: str | None, near: int = 40, min_score: float = 0.5) -> list[tuple[str, int, int, float]]:
    """Spans (kind, start, end, score) by start, then kind as listed; offsets in code points."""
    text = text or ""
    found = []
    for kind in KINDS:
        for start, end in _plain(kind, text):
            before, after = text[max(0, start - near - 1):start].lower(), text[end:end + near + 1].lower()
            good, bad = (_distance(words[kind], before, after, near) for words in (_FOR, _AGAINST))
            if good is not None and (bad is None or good <= bad):  # the nearest word decides
                score = SCORES[kind] + 0.2
            else:
                score = SCORES[kind] - 0.3 * (bad is not None)
            score = round(min(1.0, max(0.0, score)), 2)
            if kind in BASE or score >= min_score:
                found.append((kind, start, end, score))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def joined(spans: Iterable[tuple]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end, *_ in spans)


def masked(text: str | None, spans: Iterable[tuple]) -> str:
    """The text with every span replaced by its kind; overlapping spans become one."""
    text, out, at = text or "", [], 0
    for kind, start, end, *_ in spans:
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


SPANS = ("doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint,score:double>>, "
         "masked string")
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                            ("score", pa.float64())]))


def spans(docs: DataFrame, near: int = 40, min_score: float = 0.5) -> DataFrame:
    """One row per document: its spans with scores, and the masked text."""
    def scan(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = [find(t, near, min_score) for t in texts]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").cast(pa.int64()),
                pa.array([[dict(zip(("kind", "start", "end", "score"), s)) for s in f] for f in found],
                         _SPAN),
                pa.array([masked(t, f) for t, f in zip(texts, found)], pa.string())],
                names=["doc_id", "spans", "masked"])

    return map_arrow(docs.select("doc_id", "text"), scan, SPANS)


# ---------------------------------------------------------------- query

DIGEST = ("doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
          "base_sha256 string, spans string, n_added bigint, mean_score double")


def op3_pii_spans(spark, sf_dir) -> DataFrame:
    found = spans(table(spark, sf_dir, "documents")).select("doc_id", "spans")

    def reduce(batches):
        for batch in batches:
            rows = {c: [] for c in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans",
                                    "n_added", "mean_score")}
            for got in batch.column("spans").to_pylist():
                all_spans = [(s["kind"], s["start"], s["end"]) for s in got]
                base = [s for s in all_spans if s[0] in BASE]
                for kind in BASE:
                    rows[f"n_{kind}"].append(sum(s[0] == kind for s in base))
                rows["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                rows["spans"].append(joined(all_spans))
                rows["n_added"].append(len(all_spans) - len(base))
                rows["mean_score"].append(round(sum(s["score"] for s in got) / len(got), 4)
                                          if got else None)
            kinds = {"base_sha256": pa.string(), "spans": pa.string(), "mean_score": pa.float64()}
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"),
                 *[pa.array(v, kinds.get(c, pa.int64())) for c, v in rows.items()]],
                names=["doc_id", *rows])

    return map_arrow(found, reduce, DIGEST)
