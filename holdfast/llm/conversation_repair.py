"""Conversation structure repair: cheapest edits by an automaton of shared suffixes.

1. Each row of a conversation becomes a symbol of its role and its fault, so a conversation is a signature. Only turn, role,
   two hashes of the text and flags are shuffled for that; rows repeated in a conversation are found by a window over the
   hashes, which spreads one long conversation over tasks.
2. Different signatures are sorted by their reverse and cut into ranges. A node of the automaton is a suffix; in this order
   signatures that end alike follow each other, so each node is made once, and a task holds only the path of the current
   signature. A node holds, for each grammar state, the cost to go and the first edit of the best audit, made from the node
   behind it. Edits of one cost are decided by their first letters, as no two of them begin alike; the audit of a
   signature follows from its nodes' first edits.
3. The audits go back to the conversations, and texts are read once, in order, behind the audit of their conversation, for
   the repaired form.

A conversation is read by one task as a stream in Spark's sorted order: kept in memory are one byte a row (signature) and its
audit, never its texts. Hot signatures are one row each before the automaton; their join is broadcast if proven small and
split by Spark otherwise.

The grammar of role initials is ``(s?(ua)+)?``. States: E at the start, S behind s, A behind u, U behind ua.

Defined results: NULL in role or text is one space; in ``conv_id:turn`` too. Rows without conv_id are one conversation. Rows
of one turn are ordered by role, then by hashes of the text; repeated rows are rows of their own. An empty role is no legal
initial. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from array import array

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from holdfast.llm.common import WORD, map_arrow, stored, table

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
FAR = 1 << 60
STATES = "ESAU"
E, S, A, U = range(4)
AFTER = (A, A, U, A)  # the state behind the role that a state expects
WANTED = ("u", "u", "a", "u")
NAMES = {"u": "user", "a": "assistant"}
#: What is broadcast at most: rows, and characters of signatures and audits (counted).
MOST_ROWS, MOST_CHARS = 1_000_000, 64 << 20


def _or_space(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with the stated damage by ``crc32(conv_id:turn) % 20``."""
    code = F.pmod(F.crc32(F.concat(_or_space("conv_id"), F.lit(":"), _or_space("turn"))), F.lit(20))
    marked = rows.select("conv_id", "turn", _or_space("role").alias("role"), _or_space("text").alias("text"),
                         code.alias("_code")).filter("_code != 0")
    text = (F.when(F.col("_code") == 1, "").when(F.col("_code") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text")))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("_code") == 3, 2).otherwise(1)))
    return marked.select("conv_id", "turn", F.when(F.col("_code") == 4, "user").otherwise(F.col("role")).alias("role"),
                         text.alias("text"), copies.alias("_copy")).drop("_copy")


def described(rows: DataFrame) -> DataFrame:
    """Each row with its kind of role, its fault and the two hashes that stand for its text."""
    initial = F.substring("role", 1, 1)
    last = F.substring(F.regexp_extract("text", r"[^\x20\x09-\x0D][\x20\x09-\x0D]*+\z", 0), 1, 1)
    flat = rows.select("conv_id", "turn", "role", "text", F.xxhash64("text").alias("h1"),
                       F.xxhash64(F.lit(1), "text").alias("h2"),
                       F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("kind"),
                       (~F.col("text").rlike(WORD)).alias("blank"), last.isin(".", "!", "?").alias("ended"))
    return flat


ORDER = ["turn", "role", "h1", "h2"]
SIGNED = ("conv_id bigint, signature string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
          "illegal bigint")


def signatures(rows: DataFrame) -> DataFrame:
    """One row per conversation with its signature and its counts, from ``described`` rows.

    Symbols: ``s u a x`` (another role), in capitals if truncated, ``d`` for a row that has to go.
    """
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "h1", "h2").orderBy("turn")) > 1
    narrow = rows.select("conv_id", *ORDER, "kind", "blank", "ended")
    fault = (F.when(F.col("blank"), "b").when(again, "d").when(F.col("ended"), "").otherwise("t"))
    marked = narrow.select("conv_id", *ORDER, "kind", fault.alias("fault"))
    n = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = marked.repartition(n, "conv_id").sortWithinPartitions("conv_id", *ORDER)

    def sign(batches):
        now, found = None, []

        def closed(c):
            conv, symbols, first, last, turns, faults, illegal, _, _ = c
            gaps = last - first + 1 - turns if turns else 0
            return (conv, symbols.decode(), min(gaps, (1 << 63) - 1), faults["b"], faults["d"], faults["t"], illegal)

        for batch in batches:
            for conv, turn, kind, fault in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "kind", "fault"))):
                if now is None or now[0] != conv:
                    if now is not None:
                        found.append(closed(now))
                    now = [conv, bytearray(), None, None, 0, {"b": 0, "d": 0, "t": 0, "": 0}, 0, "", None]
                now[1] += (b"d" if fault in ("b", "d") else kind.upper().encode() if fault == "t" else kind.encode())
                if turn is not None and turn != now[8]:
                    now[2] = turn if now[2] is None else now[2]
                    now[3], now[8] = turn, turn
                    now[4] += 1
                now[5][fault] += 1
                now[6] += bool(now[7]) and now[7] + kind not in ("su", "ua", "au")
                now[7] = kind
            if found:
                yield _batch(found, SIGNED)
                found = []
        if now is not None:
            yield _batch([closed(now)], SIGNED)

    return map_arrow(dealt.select("conv_id", "turn", "kind", "fault"), sign, SIGNED)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    names, types = zip(*(c.split() for c in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(zip(*rows), types)], names=list(names))


class Suffixes:
    """The path of nodes of one signature, from its end; a node per suffix, kept while the next signature shares it."""

    def __init__(self):
        self.path = bytearray()  # symbols from the end
        self.cost = array("q", [0, FAR, FAR, 0])  # four states a node; the first node is the empty suffix
        self.edit = bytearray(b"....")
        self.made = 0
        self._inserted(0)

    def _inserted(self, at: int) -> None:
        """Lets a node also begin with inserted rows, where that is cheaper or, at the same cost, less in ASCII."""
        cost, edit = self.cost, self.edit
        base = cost[at + A], cost[at + U]
        for state, behind in ((A, base[1]), (U, base[0])):
            self._better(at + state, INSERT + behind, b"I")
        for state in (E, S):
            self._better(at + state, INSERT + cost[at + A], b"I")
        assert len(cost) == len(edit)

    def _better(self, at: int, cost: int, letter: bytes) -> None:
        if cost < FAR and (cost < self.cost[at] or (cost == self.cost[at] and letter[0] < self.edit[at])):
            self.cost[at], self.edit[at] = cost, letter[0]

    def _push(self, symbol: int) -> None:
        self.made += 1
        kind, at = chr(symbol), len(self.cost)
        self.path.append(symbol)
        behind = self.cost[at - 4:at]
        self.cost.extend((FAR,) * 4)
        self.edit += b"...."
        extra = TRUNCATED if kind.isupper() else 0
        for state in (E, S, A, U):
            self._better(at + state, DELETE + behind[state], b"D")
            if kind != "d":
                self._better(at + state, REROLE + extra + behind[AFTER[state]], b"R")
                if kind.lower() == WANTED[state]:
                    self._better(at + state, extra + behind[AFTER[state]], b"K")
                if kind.lower() == "s" and state == E:
                    self._better(at + state, extra + behind[S], b"K")
        self._inserted(at)

    def repair(self, signature: str) -> tuple[int, str]:
        """Cost and audit of a signature; nodes of the suffix shared with the one before are kept."""
        turned = signature.encode()[::-1]
        shared, most = 0, min(len(turned), len(self.path))
        if turned[:most] == self.path[:most]:
            shared = most
        else:
            while turned[shared] == self.path[shared]:
                shared += 1
        del self.path[shared:], self.cost[4 * shared + 4:], self.edit[4 * shared + 4:]
        for symbol in turned[shared:]:
            self._push(symbol)
        audit, node, state = bytearray(), len(turned), E
        while (letter := self.edit[4 * node + state]) != ord("."):
            audit.append(letter)
            if letter != ord("D"):
                state = S if letter == ord("K") and turned[node - 1] in b"sS" else AFTER[state]
            node -= letter != ord("I")
        return self.cost[4 * len(turned) + E], audit.decode()


REPAIRED = "signature string, cost bigint, audit string"


def repairs(signed: DataFrame) -> DataFrame:
    """``signature, cost, audit`` of each different signature."""
    def run(batches):
        nodes = Suffixes()
        for batch in batches:
            rows = [(s, *nodes.repair(s)) for s in batch.column("signature").to_pylist()]
            if rows:
                yield _batch(rows, REPAIRED)

    n = max(1, int(signed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    turned = F.reverse("signature")
    return map_arrow(signed.select("signature").distinct().repartitionByRange(n, turned).sortWithinPartitions(turned),
                     run, REPAIRED)


HASHED = "conv_id bigint, repaired_sha256 string"


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's repaired rows, from ``described`` rows and ``conv_id, audit``."""
    blank = {c: F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in [*ORDER, "kind", "text"]}
    first = audits.select("conv_id", F.lit(0).alias("part"), *blank.values(), "audit")
    rest = rows.select("conv_id", F.lit(1).alias("part"), *blank, F.lit(None).cast("string").alias("audit"))
    n = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = first.unionByName(rest).repartition(n, "conv_id").sortWithinPartitions("conv_id", "part", *ORDER)

    def run(batches):
        now, found = None, []

        def put(c, role, text):
            c["sum"].update(((b"\n" if c["any"] else b"") + f"{role}:{text}".encode("utf-8", "surrogatepass")))
            c["any"] = True

        def inserted(c):
            while c["at"] < len(c["audit"]) and c["audit"][c["at"]] == "I":
                put(c, NAMES[WANTED[c["state"]]], "")
                c["state"], c["at"] = AFTER[c["state"]], c["at"] + 1

        def closed(c):
            inserted(c)
            return c["conv"], c["sum"].hexdigest()

        for batch in batches:
            names = ("conv_id", "part", "role", "kind", "text", "audit")
            for conv, part, role, kind, text, audit in zip(*(batch.column(c).to_pylist() for c in names)):
                if part == 0:
                    if now is not None:
                        found.append(closed(now))
                    now = {"conv": conv, "audit": audit, "at": 0, "state": E, "any": False, "sum": hashlib.sha256()}
                    continue
                inserted(now)
                letter, state = now["audit"][now["at"]], now["state"]
                now["at"] += 1
                if letter == "D":
                    continue
                put(now, role if letter == "K" else NAMES[WANTED[state]], text)
                now["state"] = S if letter == "K" and kind == "s" else AFTER[state]
            if found:
                yield _batch(found, HASHED)
                found = []
        if now is not None:
            yield _batch([closed(now)], HASHED)

    return map_arrow(dealt.select("conv_id", "part", "role", "kind", "text", "audit"), run, HASHED)


def repair(rows: DataFrame, conv_ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``rows`` (``conv_id, turn, role, text`` as they are), or of ``conv_ids``: ``conv_id, gaps,
    blank, duplicate, truncated, illegal, cost, audit, signature, repaired_sha256``. A conversation without rows has zeros
    and empty texts."""
    flat = rows.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                       _or_space("role").alias("role"), _or_space("text").alias("text"))
    flat = described(flat)
    signed = stored(signatures(flat), "conversation-signatures")
    best = stored(repairs(signed), "conversation-repairs")
    size = best.agg(F.count("*").alias("n"), F.sum(F.length("signature") + F.length("audit")).alias("c")).first()
    few = size.n <= MOST_ROWS and (size.c or 0) <= MOST_CHARS
    known = stored(signed.join(F.broadcast(best) if few else best, "signature"), "conversation-audits")
    sums = repaired(flat, known.select("conv_id", "audit"))
    ids = (rows if conv_ids is None else conv_ids).select(F.col("conv_id").cast("bigint").alias("c")).distinct()
    both = known.join(sums.withColumnRenamed("conv_id", "k"), F.col("conv_id").eqNullSafe(F.col("k"))).drop("k")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return ids.join(both, F.col("c").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("c").alias("conv_id"), *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("audit", "signature")],
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


# ---------------------------------------------------------------- query

def op11_conversation_repair(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return repair(damaged(rows), rows)
