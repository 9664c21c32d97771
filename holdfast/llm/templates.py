"""Benchmark decontamination by templates: a question is found again with other numbers, names or units.

Texts become template tokens: words in small letters, and typed placeholders for numbers, names (capitalised
inside a sentence) and units (after a number). Windows of ``WINDOW`` template tokens of the documents are
hash-joined with those of the benchmark. A document and an item that agree in enough windows at one shift are
aligned, and their slots must be consistent: one value of the item stands for one value of the document.

Only DataFrame expressions. The benchmark's windows are broadcast if they are at most ``MOST_WINDOWS``
(counted), so that documents are neither shuffled nor expanded beyond the task; else they are joined by shuffle.
Only aligned documents are read a second time.

Items without a window that says something, and those of at most ``MIN_WINDOWS`` windows, are also found whole: all
template tokens but the first, the first word however it is written, and consistent slots; equal tokens where few are
words or under ``MIN_TOKENS``, and then the same text too. Such an agreement counts as one window.

The documents are read once for all sizes of windows, and once more if there are items to be found whole.

Defined results: documents and items without id or text, or without a token, match nothing. Items shorter than a window
count as one window. Repeated rows of a document
are one document. Equal items are each found. Other columns are ignored. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import let, semi, stored, table

WINDOW = 8
MIN_TOKENS = 5
MIN_WINDOWS = 6
LITERAL_PCT = 60  # a window says something if this share of its tokens are words
MOST_WINDOWS = 500_000
#: A word that begins a sentence, a name of capitalised words, a number, another word.
TOKEN = (r"[.!?…\n][^\p{L}\p{N}]*\p{L}+|\p{Lu}\p{Ll}\p{L}*(?:\x20\p{Lu}\p{Ll}\p{L}*)*"
         r"|[0-9]+(?:[.,][0-9]+)*|\p{L}+")
#: The same in one pass without going back, which Java runs as a loop and not as one call per repetition. Marks that
#: no word follows are found too, so that a run of them is read once; ``tokens`` drops them.
TOKEN_RUN = (r"[.!?…\n][^\p{L}\p{N}]*+\p{L}*+|\p{Lu}\p{Ll}\p{L}*+(?:\x20\p{Lu}\p{Ll}\p{L}*+)*+"
             r"|[0-9]++(?:[.,][0-9]++)*+|\p{L}++")
SENTENCE = ".!?…\n"
NAME = r"^\p{Lu}\p{Ll}"  # words in capitals and single capitals are no names
#: Fixed list of units.
UNITS = ("mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres "
         "kilometer kilometers mg g kg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces "
         "ton tons ml l liter liters litre litres gallon gallons s sec secs second seconds min mins minute "
         "minutes h hr hrs hour hours day days week weeks month months year years cent cents dollar "
         "dollars euro euros percent mph kmh kph degree degrees").split()


def tokens(text: Column) -> Column:
    """Tokens as they stand in the text."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN_RUN), F.lit(0))
    return F.filter(found, lambda t: ~_first(t).isin(*SENTENCE) | t.rlike(r"\p{L}\z"))


def _first(token: Column) -> Column:
    return F.substring(token, 1, 1)


def template(raw: Column) -> Column:
    """Tokens to template tokens; placeholders are ``<num>``, ``<name>`` and ``<unit>``."""
    def one(token: Column, i: Column) -> Column:
        return let(_first(token), lambda c: (
            F.when(c.between("0", "9"), "<num>")
            .when(c.isin(*SENTENCE), F.lower(F.regexp_extract(token, r"\p{L}+$", 0)))
            .when((c != F.lower(c)) & (i > 0) & token.rlike(NAME), "<name>")
            .when(token.isin(*UNITS) & (i > 0) & _first(F.get(raw, i - 1)).between("0", "9"), "<unit>")
            .otherwise(F.lower(token))))

    return F.transform(raw, one)


def _is_slot(token: Column) -> Column:
    return token.startswith("<")


def _hashes(canon: Column, size: int) -> Column:
    return F.when(F.size(canon) >= size, F.transform(
        F.sequence(F.lit(0), F.size(canon) - size),
        lambda i: F.xxhash64(*[F.get(canon, i + k) for k in range(size)])))


def _items(benchmark: DataFrame) -> DataFrame:
    """Items with their tokens: ``item_id, raw, canon, size`` (the window that they use)."""
    found = (benchmark.filter("item_id is not null").select("item_id", tokens(F.col("text")).alias("raw"))
             .select("item_id", "raw", let(F.col("raw"), template).alias("canon"))
             .filter(F.size("raw") >= MIN_TOKENS))
    return found.withColumn("size", F.least(F.size("raw"), F.lit(WINDOW)))


def _item_windows(items: DataFrame, sizes: list[int]) -> DataFrame:
    """``size, h, item_id, bpos`` of each window with enough words."""
    parts = []
    for size in sizes:
        literal = F.transform(F.sequence(F.lit(0), F.size("canon") - size), lambda i: F.size(F.filter(
            F.slice("canon", i + 1, size), lambda t: ~_is_slot(t))) * 100 >= size * LITERAL_PCT)
        parts.append(items.filter(F.col("size") == size)
                     .select("item_id", F.posexplode(F.arrays_zip(
                         _hashes(F.col("canon"), size).alias("h"), literal.alias("ok"))).alias("bpos", "w"))
                     .filter("w.ok").select(F.lit(size).alias("size"), F.col("w.h").alias("h"),
                                            "item_id", "bpos"))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def _bare(token: Column) -> Column:
    """A token in small letters without the marks before it."""
    return F.regexp_replace(F.lower(token), r"^[^\p{L}\p{N}]+", "")


def _last(raw: Column) -> Column:
    """The last word of each token, so that a name merged with capitals before it is known by its end."""
    return F.transform(raw, lambda t: F.regexp_extract(_bare(t), r"[^\x20]*$", 0))


def _spaced(text: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _whole(texts: DataFrame, benchmark: DataFrame, windows: DataFrame) -> DataFrame | None:
    """Documents that hold a whole item that is short or has none of ``windows``; rows as those of ``leaks``. None if
    there is no such item."""
    texts_of = benchmark.filter("item_id is not null and text is not null").select("item_id", "text")
    forms = None
    for before in ("", "\n"):  # inside a line, and as the beginning of a sentence
        form = (texts_of.select("item_id", "text", tokens(F.concat(F.lit(before), F.ltrim("text"))).alias("raw"))
                .select("item_id", "text", "raw", let(F.col("raw"), template).alias("canon")))
        forms = form if forms is None else forms.union(form)
    n = F.size("raw")
    few = ((F.size(F.filter("canon", lambda t: ~_is_slot(t))) * 100 < n * LITERAL_PCT) | (n < MIN_TOKENS))
    forms = (forms.filter(n > 0).withColumn("equal", few)
             .join(windows.select("item_id").distinct().withColumn("has", F.lit(True)), "item_id", "left")
             .filter(F.col("has").isNull() | (n < WINDOW + MIN_WINDOWS)).drop("has")
             .withColumn("size", F.least(F.when(F.col("equal"), n).otherwise(n - 1), F.lit(WINDOW))).distinct())
    forms = stored(forms.withColumn("form", F.xxhash64("item_id", "raw")), "whole-items")
    kinds = sorted(tuple(r) for r in forms.select("equal", "size").distinct().collect())  # at most 2 x WINDOW
    if not kinds:
        return None

    def key(equal: bool, raw: Column, canon: Column) -> Column:
        return _last(raw) if equal else F.slice(canon, 2, F.size(canon))

    def by_kind(raw: Column, canon: Column) -> Column:
        """The hashes of each kind, in the order of ``kinds``."""
        sides = {equal: [size for e, size in kinds if e == equal] for equal in sorted({e for e, _ in kinds})}
        def of(sizes: list[int]):
            return lambda k: F.array(*[_hashes(k, size) for size in sizes])

        return F.concat(*[let(key(equal, raw, canon), of(sizes)) for equal, sizes in sides.items()])

    wanted = None
    for k, (equal, size) in enumerate(kinds):
        part = forms.filter((F.col("equal") == equal) & (F.col("size") == size)).select(
            F.lit(k).alias("kind"),
            F.get(let(key(equal, F.col("raw"), F.col("canon")), lambda c: _hashes(c, size)), 0).alias("h"), "form")  # noqa: B023
        wanted = part if wanted is None else wanted.union(part)
    wanted = stored(wanted, "whole-wanted")
    few_rows = wanted.limit(MOST_WINDOWS + 1).count() <= MOST_WINDOWS
    hashed = let(tokens(F.col("text")), lambda raw: let(template(raw), lambda canon: by_kind(raw, canon)))
    spread = (texts.select("doc_id", F.posexplode(hashed).alias("kind", "hs"))
              .select("doc_id", "kind", F.posexplode("hs").alias("at", "h")))
    found = spread.join(F.broadcast(wanted) if few_rows else wanted, ["kind", "h"]).select("doc_id", "form", "at")
    found = stored(found.distinct(), "whole-hits")
    own = (semi(texts, stored(found.select("doc_id").distinct(), "whole-ids"), "doc_id")
           .select("doc_id", F.col("text").alias("dtext"), tokens(F.col("text")).alias("draw"))
           .withColumn("dcanon", let(F.col("draw"), template)))
    met = found.join(forms, "form").join(own, "doc_id").filter(F.size("draw") >= F.col("at") + n)
    part = lambda c: F.slice(c, F.col("at") + 1, n)
    met = met.select("doc_id", "item_id", "at", "equal", "raw", "canon", "text", "dtext",
                     part("draw").alias("draw"), part("dcanon").alias("dcanon"))
    rest = lambda c: F.slice(c, 2, F.size(c))
    bare = lambda c: F.transform(rest(c), _bare)
    mine, theirs = _bare(F.get("raw", 0)), _bare(F.get("draw", 0))
    first = ((theirs == mine) | theirs.endswith(F.concat(F.lit(" "), mine))
             | (~F.col("equal") & _is_slot(F.get("canon", 0)) & (F.get("canon", 0) == F.get("dcanon", 0))))
    same = F.when(F.col("equal"), bare("raw") == bare("draw")).otherwise(rest("canon") == rest("dcanon"))
    text = (n >= MIN_TOKENS) | F.contains(_spaced(F.col("dtext")), _spaced(F.col("text")))
    slots = F.transform(
        F.filter(F.sequence(F.lit(0), n - 1), lambda i: (
            _is_slot(F.get("canon", i)) & (F.get("canon", i) == F.get("dcanon", i)))),
        lambda i: F.struct(F.concat(F.get("canon", i), _bare(F.get("raw", i))).alias("item"),
                           F.concat(F.get("canon", i), _bare(F.get("draw", i))).alias("doc")))
    judged = (met.filter(first & same & text).select("doc_id", "item_id", "at", slots.alias("slots"))
              .filter(F.size(F.array_distinct("slots")) == F.size(F.array_distinct("slots.item")))
              .groupBy("doc_id", "item_id").agg(F.min(F.struct(
                  F.size(F.filter("slots", lambda s: s["item"] != s["doc"])).alias("n_changed"), "at",
                  F.size("slots").alias("n_slots"))).alias("best")))
    return judged.select("doc_id", "item_id", F.lit(1).cast("long").alias("n_windows"),
                         F.lit(1).cast("long").alias("item_windows"), F.col("best.n_slots").cast("long").alias("n_slots"),
                         F.col("best.n_changed").cast("long").alias("n_changed"))


def leaks(docs: DataFrame, benchmark: DataFrame, min_windows: int = MIN_WINDOWS) -> DataFrame:
    """``doc_id, item_id, n_windows, item_windows, n_slots, n_changed`` of each document and item that agree.

    At least ``min_windows`` windows of the item (all, if it has fewer) agree at one shift with consistent slots.
    n_changed counts slots whose value differs from the item's.
    """
    items = stored(_items(benchmark), "items")
    sizes = sorted(r[0] for r in items.select("size").distinct().collect())  # at most WINDOW values
    if not sizes:
        sizes = [WINDOW]
    windows = stored(_item_windows(items, sizes), "item-windows")
    few = windows.limit(MOST_WINDOWS + 1).count() <= MOST_WINDOWS
    known = windows.join(windows.groupBy("item_id").agg(F.count("*").alias("item_windows")), "item_id")

    texts = docs.filter("doc_id is not null").select("doc_id", "text")
    hashed = let(tokens(F.col("text")), lambda raw: let(template(raw), lambda canon: F.array(
        *[_hashes(canon, size) for size in sizes])))
    if len(sizes) == 1:
        spread = texts.select("doc_id", F.lit(sizes[0]).alias("size"), F.posexplode(F.get(hashed, 0)).alias("pos", "h"))
    else:
        spread = (texts.select("doc_id", F.posexplode(hashed).alias("k", "hs"))
                  .select("doc_id", F.get(F.array(*map(F.lit, sizes)), F.col("k")).alias("size"),
                          F.posexplode("hs").alias("pos", "h")))
    found = (spread.join(F.broadcast(windows) if few else windows, ["h", "size"])
             .select("doc_id", "item_id", "bpos", (F.col("pos") - F.col("bpos")).alias("shift")))
    aligned = (found.distinct().groupBy("doc_id", "item_id", "shift")
               .agg(F.count("*").alias("n_windows"), F.min("bpos").alias("lo"), F.max("bpos").alias("hi")))
    per_item = known.select("item_id", "item_windows").distinct()
    aligned = stored(aligned.join(per_item, "item_id").filter(
        F.col("n_windows") >= F.least(F.lit(min_windows), "item_windows")), "aligned")

    ids = stored(aligned.select("doc_id").distinct(), "aligned-ids")
    own = (semi(texts, ids, "doc_id").select("doc_id", tokens(F.col("text")).alias("draw"))
           .select("doc_id", "draw", let(F.col("draw"), template).alias("dcanon")))
    met = aligned.join(items.select("item_id", "raw", "canon", "size"), "item_id").join(own, "doc_id")
    value = lambda c, i: F.lower(F.get(F.col(c), i))
    slots = F.transform(
        F.filter(F.sequence(F.col("lo"), F.col("hi") + F.col("size") - 1), lambda i: (
            _is_slot(F.get("canon", i)) & (F.get("canon", i) == F.get("dcanon", i + F.col("shift"))))),
        lambda i: F.struct(F.concat(F.get("canon", i), value("raw", i)).alias("item"),
                           F.concat(F.get("canon", i), value("draw", i + F.col("shift"))).alias("doc")))
    judged = (met.select("doc_id", "item_id", "shift", "n_windows", "item_windows", slots.alias("slots"))
              .filter(F.size(F.array_distinct("slots")) == F.size(F.array_distinct("slots.item")))
              .select("doc_id", "item_id", "shift", "n_windows", "item_windows",
                      F.size("slots").alias("n_slots"),
                      F.size(F.filter("slots", lambda s: s["item"] != s["doc"])).alias("n_changed")))
    best = F.max(F.struct("n_windows", (-F.col("n_changed")).alias("same"), (-F.col("shift")).alias("at"),
                          "item_windows", "n_slots", "n_changed")).alias("best")
    by_windows = (judged.groupBy("doc_id", "item_id").agg(best)
                  .select("doc_id", "item_id", *[F.col(f"best.{c}").cast("long").alias(c) for c in (
                      "n_windows", "item_windows", "n_slots", "n_changed")]))
    whole = _whole(texts, benchmark, windows)
    if whole is None:
        return by_windows
    by_windows = stored(by_windows, "by-windows")
    return by_windows.union(whole.join(by_windows.select("doc_id", "item_id"), ["doc_id", "item_id"], "left_anti"))


def clean(docs: DataFrame, benchmark: DataFrame, min_windows: int = MIN_WINDOWS) -> DataFrame:
    """The documents that agree with no item."""
    found = stored(leaks(docs, benchmark, min_windows).select("doc_id").distinct(), "leaks")
    return semi(docs, found, "doc_id", "left_anti").select(docs.columns)


# ---------------------------------------------------------------- query

def op7_template_decontamination(spark, sf_dir) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def leaks_sql(docs: str, benchmark: str = "benchmark") -> str:
    """CTEs that end in ``leaks`` over the relations ``docs`` and ``benchmark``."""
    units = ", ".join(f"'{u}'" for u in UNITS)
    token = TOKEN.replace("'", "''")

    def canon(raw: str) -> str:
        c = f"({raw}[i + 1])[1]"
        return rf"""list_transform(range(len({raw})), lambda i: case
          when {c} between '0' and '9' then '<num>'
          when {c} in ('.', '!', '?', '…', chr(10)) then lower(regexp_extract({raw}[i + 1], '\p{{L}}+$'))
          when {c} <> lower({c}) and i > 0 and regexp_matches({raw}[i + 1], '{NAME}') then '<name>'
          when {raw}[i + 1] in ({units}) and i > 0 and ({raw}[i])[1] between '0' and '9' then '<unit>'
          else lower({raw}[i + 1]) end)"""

    def aligned_to(side: str) -> str:
        return f"list_transform(range(len({side}) - size + 1), lambda i: {side}[i + 1:i + size])"

    return rf"""
bt0 as (select item_id, regexp_extract_all(coalesce(text, ''), '{token}') as raw from {benchmark}
        where item_id is not null),
bt as (select item_id, raw, {canon('raw')} as canon, least(len(raw), {WINDOW}) as size from bt0
       where len(raw) >= {MIN_TOKENS}),
bw0 as (select item_id, size, unnest({aligned_to('canon')}) as w,
          unnest(range(len(canon) - size + 1)) as bpos from bt),
bw as (select *, count(*) over (partition by item_id) as item_windows from bw0
       where len(list_filter(w, lambda t: t[1] <> '<')) * 100 >= size * {LITERAL_PCT}),
dt0 as (select doc_id, regexp_extract_all(coalesce(text, ''), '{token}') as draw from {docs}
        where doc_id is not null),
dt as (select doc_id, draw, {canon('draw')} as dcanon from dt0),
sz as (select distinct size from bt),
dw as (select doc_id, unnest({aligned_to('dcanon')}) as w, unnest(range(len(dcanon) - size + 1)) as pos
       from dt, sz where len(dcanon) >= size),
al as (select doc_id, item_id, pos - bpos as shift, count(distinct bpos) as n_windows, min(bpos) as lo,
         max(bpos) as hi, any_value(item_windows) as item_windows
       from dw join bw using (w) group by all having count(distinct bpos) >= least({MIN_WINDOWS},
         any_value(item_windows))),
sl as (select al.doc_id, al.item_id, shift, i, canon[i + 1] || lower(raw[i + 1]) as item,
         canon[i + 1] || lower(draw[i + shift + 1]) as doc
       from (select *, unnest(range(lo, hi + size)) as i from al join bt using (item_id)) al
       join dt on dt.doc_id = al.doc_id
       where canon[i + 1][1] = '<' and canon[i + 1] = dcanon[i + shift + 1]),
sc as (select doc_id, item_id, shift, count(*) as n_slots, count(*) filter (where item <> doc) as n_changed,
         count(distinct (item, doc)) = count(distinct item) as same from sl group by all),
ju as (select al.doc_id, al.item_id, n_windows, item_windows, coalesce(n_slots, 0) as n_slots,
         coalesce(n_changed, 0) as n_changed, row_number() over (partition by al.doc_id, al.item_id
           order by n_windows desc, coalesce(n_changed, 0), al.shift) as rank
       from al left join sc using (doc_id, item_id, shift) where coalesce(same, true)),
leaks as (select doc_id, item_id, n_windows, item_windows, n_slots, n_changed from ju where rank = 1)"""


SQL = f"with {leaks_sql('documents')} select * from leaks"
