import hashlib
import itertools
import random
import re
import zlib

import pytest

from holdfast.llm import conversation_repair as C

GRAMMAR = re.compile(r"(s?(ua)+)?")
BLANK = re.compile(r"[\x20\x09-\x0D]*")


def damage(rows):
    """The stated damage, row by row."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code = zlib.crc32(key.encode()) % 20
        if code == 0:
            continue
        if code == 1:
            text = ""
        if code == 2:
            text = re.sub("[.!?]", "", text)
        if code == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if code == 3 else 1)
    return out


def cheapest(faults):
    """Least cost and then least audit, by trying edits breadth first with everything that is worse left out."""
    # state: rows read, initials so far reduced to the grammar's state
    best = {}

    def step(initials, r):
        if initials == "":
            return {"s": "s", "u": "u"}.get(r)
        return {"s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}[initials].get(r)

    todo = [(0, "", 0, "", ())]
    import heapq
    while todo:
        cost, audit, at, last, roles = heapq.heappop(todo)
        if (at, last) in best:
            continue
        best[at, last] = True
        if at == len(faults) and last in ("", "a"):
            return cost, audit, roles
        for r in "ua":
            nxt = step(last, r)
            if nxt:
                heapq.heappush(todo, (cost + 3, audit + "I", at, nxt, roles + ((None, r),)))
        if at < len(faults):
            initial, fault = faults[at]
            heapq.heappush(todo, (cost + 4, audit + "D", at + 1, last, roles))
            if fault not in ("b", "d"):
                more = 3 if fault == "t" else 0
                if step(last, initial):
                    heapq.heappush(todo, (cost + more, audit + "K", at + 1, step(last, initial), roles + ((at, None),)))
                for r in "ua":
                    if step(last, r):
                        heapq.heappush(todo, (cost + more + 3, audit + "R", at + 1, step(last, r), roles + ((at, r),)))
    raise AssertionError


def brute(rows, ids):
    by = {}
    for row in rows:
        by.setdefault(row[0], []).append(row)
    out = {}
    for conv in ids:
        own = sorted(by.get(conv, []), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        seen, faults = set(), []
        for _, _, role, text in own:
            body = text.strip(" \t\n\x0b\f\r")
            fault = ("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
            seen.add((role, text))
            faults.append((role[:1], fault))
        turns = [r[1] for r in own if r[1] is not None]
        cost, audit, roles = cheapest(faults)
        initials = "".join(own[k][2][:1] if r is None else r for k, r in roles)
        assert GRAMMAR.fullmatch(initials)
        text = "\n".join(f"{own[k][2] if r is None else C.NAMES[r]}:{'' if k is None else own[k][3]}" for k, r in roles)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                     *(sum(f == c for _, f in faults) for c in "bdt"),
                     sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(faults)),
                     cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def got_of(frame):
    rows = frame.collect()
    found = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_against_brute_force(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    query = C.op11_conversation_repair(spark, folder)
    assert got_of(query) == brute(damage(rows), {r[0] for r in rows})
    kinds = dict(query.dtypes)
    assert all(kinds[c] == "bigint" for c in COLUMNS[:6]) and kinds["audit"] == kinds["repaired_sha256"] == "string"


def test_random_signatures_against_search():
    rng, nodes = random.Random(3), C.Suffixes()
    signatures = sorted(("".join(rng.choice("suaxSUAXd") for _ in range(rng.randrange(8))) for _ in range(1500)),
                        key=lambda s: s[::-1])
    for s in signatures:
        faults = [("?" if c == "d" else c.lower(), "d" if c == "d" else "t" if c.isupper() else "") for c in s]
        cost, audit, _ = cheapest(faults)
        assert nodes.repair(s) == (cost, audit), s
    different = {s[k:] for s in signatures for k in range(len(s))}
    assert nodes.made == len(different)  # each node once


def test_any_order_gives_the_same():
    words = ["".join(w) for n in range(4) for w in itertools.product("suAd", repeat=n)]
    one = {w: C.Suffixes().repair(w) for w in words}
    nodes = C.Suffixes()
    random.Random(1).shuffle(words)
    assert {w: nodes.repair(w) for w in words} == one


def test_edges(spark):
    long = "word " * 40_000 + "end."
    rows = [(1, 1, "user", "Hi there."), (1, 2, "assistant", "Yes."), (1, 2, "assistant", "Yes."), (1, 9, "user", long),
            (2, None, "user", "No turn."), (2, None, None, None), (2, 3, "", "No role."), (2, 4, "tool", "Other."),
            (3, 1, "system", "Only this."), (None, 1, "user", "No conversation"), (None, None, None, None),
            (4, 1, "system", "Be kind."), (4, 2, "user", "é ß ?"), (4, 3, "assistant", "😀!"), (5, 7, "user", "\t\n "),
            (6, -2 ** 63, "user", "First."), (6, 2 ** 63 - 1, "assistant", "Last.")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr(
        "*", *[f"1 as `{c}`" for c in "kind blank ended h1 h2 fault part audit signature cost k c _code".split()])
    want = brute([(a, b, " " if c is None else c, " " if d is None else d) for a, b, c, d in rows], {r[0] for r in rows})
    want[6] = (2 ** 63 - 1, *want[6][1:])  # the widest gap a long holds
    assert got_of(C.repair(frame)) == want
    assert C.repair(frame.limit(0)).count() == 0
    after = got_of(C.repair(C.damaged(frame), frame))
    want = brute(damage(rows), {r[0] for r in rows})
    assert {k: v[1:] for k, v in after.items()} == {k: v[1:] for k, v in want.items()}


def test_dropped_conversation_has_zeros(spark):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame([(gone, 0, "user", "All of it goes.")], "conv_id bigint, turn bigint, role string, text string")
    assert got_of(C.repair(C.damaged(frame), frame)) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_one_long_conversation(spark):
    rows = [(1, k, ("user", "assistant")[k % 2], f"Turn {k}" + "." * (k % 7 != 0)) for k in range(30_000)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    r = C.repair(frame).collect()[0]
    assert len(r.audit) >= 29_000 and r.truncated == sum(k % 7 == 0 for k in range(30_000)) and r.cost == 3 * r.truncated
