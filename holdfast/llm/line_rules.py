"""Quality rules, line first: judge every line, take failing lines out, then judge the document.

Only DataFrame expressions; one projection per document, no shuffle, so neither a hot source nor a
group of copies meets in a task.

Defined results: a NULL or empty text has no words, fails the base rule and is rejected. Lines without
a word are neither judged nor counted and stay where they are. Repeated rows are judged alike, each by
itself. Columns of the input other than the text are passed through; a column of the input with the
name of a verdict column is replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import let, words_of

SYMBOLS = "#*$%&|<>"
SEPARATORS = "|»›•"
#: Fixed phrases of page furniture; a line of at most ``furniture_chars`` with one of them goes.
FURNITURE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy",
    "uses cookies", "enable javascript", "click here", "read more", "sign in", "log in",
    "subscribe to", "skip to content", "share this", "licensed under", "released under the",
    "this work is licensed",
)
#: Sentence marks of the scripts in use: Latin, CJK, Arabic, Devanagari, Armenian, Ethiopic, Burmese, Khmer, Tibetan.
SENTENCE_MARK = "[.!?;:…。！？；：．｡؛؟۔।॥։።፧၊။។༎]"  # a line of prose has one


@dataclass(frozen=True)
class LineRules:
    """Thresholds. Shares are in percent and compared as whole numbers, so that every engine agrees.

    symbol_pct: symbols among a line's non-blank characters. separators: how many ``| » › •`` make a
    navigation line, if there is one for every four words too. shout_chars: a line of so many non-blank
    characters, with two capitals in a row and no small letter, is shouting. repeat_words,
    distinct_pct: a line of so many words of which fewer than this share are different. furniture_chars:
    longest line that a furniture phrase condemns. lost_pct: a document that loses more than this
    share of its non-blank characters is rejected.
    """

    symbol_pct: int = 10
    separators: int = 3
    shout_chars: int = 15
    repeat_words: int = 10
    distinct_pct: int = 25
    furniture_chars: int = 200
    lost_pct: int = 50


def _count(text: Column, chars: str) -> Column:
    """How many of ``chars`` a text has."""
    return F.length(text) - F.length(F.regexp_replace(text, _class(chars), ""))


def _class(chars: str) -> str:
    return "[" + "".join("\\" + c if c in "]|" else c for c in chars) + "]"


def _total(parts: Column, value) -> Column:
    """Sum of ``value(part)`` over an array."""
    return F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a + value(x))


def judged_line(line: Column, rules: LineRules) -> Column:
    """A line with its words, non-blank characters, symbols, and whether a punctuation, navigation or boilerplate
    rule removes it."""
    def with_words(words: Column) -> Column:
        return let(F.struct(F.length(F.array_join(words, "")).alias("chars"),
                            _count(line, SYMBOLS).alias("symbols")), lambda n: F.struct(
            line.alias("line"), words.alias("words"), n["chars"].alias("chars"), n["symbols"].alias("symbols"),
            ((F.size(words) > 0) & bad(words, n["chars"], n["symbols"])).alias("bad")))

    def bad(words: Column, chars: Column, symbols: Column) -> Column:
        seps = _count(line, SEPARATORS)
        return ((symbols * 100 > chars * rules.symbol_pct)
                | ~line.rlike(SENTENCE_MARK)
                | ((chars >= rules.shout_chars) & ~line.rlike(r"\p{Ll}") & line.rlike(r"\p{Lu}{2}"))
                | ((F.length(line) <= rules.furniture_chars) & F.lower(line).rlike("|".join(FURNITURE)))
                | (line.rlike(_class(SEPARATORS)) & (seps >= rules.separators) & (seps * 4 >= F.size(words)))
                | ((F.size(words) >= rules.repeat_words)
                   & (F.size(F.array_distinct(words)) * 100 < F.size(words) * rules.distinct_pct)))

    return let(words_of(line), with_words)


def repeated_words(words: Column, n: int = 5) -> Column:
    """How many words lie in an ``n``-word window that the text has at least twice.

    Windows are compared by a 64-bit hash inside one text. Linear but for one sort, which only texts with
    a repeated window need.
    """
    def count(w: Column) -> Column:
        hashes = F.transform(w, lambda x: F.xxhash64(x))
        windows = let(hashes, lambda h: F.transform(
            F.sequence(F.lit(0), F.size(h) - n), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(n)])))
        return let(windows, covered)

    def covered(h: Column) -> Column:
        spread = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        places = let(spread, lambda s: F.sort_array(F.filter(
            F.transform(s, lambda x, k: F.when(
                ((k > 0) & (F.get(s, k - 1)["h"] == x["h"]))
                | (F.get(s, k + 1)["h"] == x["h"]), x["i"])),
            lambda p: p.isNotNull())))
        total = let(places, lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(n), F.coalesce(F.get(p, k + 1) - x, F.lit(n)))),
            F.lit(0), lambda a, b: a + b))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), total).otherwise(F.lit(0))

    return F.when(F.size(words) < n + 1, F.lit(0)).otherwise(let(words, count))


FIELDS = ("n_words", "n_repeat_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_bad_lines",
          "clean_chars", "clean_text", "base_failed", "kept")


def verdict(text: Column, rules: LineRules = LineRules()) -> Column:
    """Struct of ``FIELDS`` for a text: the counts, the verdicts and the text without its failing lines.

    Every line is split into words once; all counts of the document follow from its lines.
    """
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: judged_line(x, rules))

    def counts(ls: Column, worded: Column) -> Column:
        return F.struct(
            let(F.flatten(F.transform(worded, lambda x: x["words"])), lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"), repeated_words(w).cast("long").alias("n_repeat_words")))
            .alias("words"),
            _total(worded, lambda x: x["chars"]).alias("word_chars"),
            _total(ls, lambda x: x["symbols"]).alias("n_symbols"),
            (F.size(worded) - F.size(F.array_distinct(F.transform(worded, lambda x: x["line"]))))
            .cast("long").alias("n_dup_lines"),
            F.size(worded).cast("long").alias("n_lines"),
            F.size(F.filter(worded, lambda x: x["bad"])).cast("long").alias("n_bad_lines"),
            _total(F.filter(worded, lambda x: ~x["bad"]), lambda x: x["chars"]).alias("clean_chars"),
            F.array_join(F.transform(F.filter(ls, lambda x: ~x["bad"]), lambda x: x["line"]), "\n")
            .alias("clean_text"))

    def judged(c: Column) -> Column:
        n, again, chars = c["words"]["n_words"], c["words"]["n_repeat_words"], c["word_chars"]
        failed = (n < 10) | (again * 100 > n * 20)
        kept = ~failed & ((chars - c["clean_chars"]) * 100 <= chars * rules.lost_pct)
        return F.struct(n.alias("n_words"), again.alias("n_repeat_words"),
                        *[c[f].alias(f) for f in FIELDS[2:-2]], failed.alias("base_failed"), kept.alias("kept"))

    return let(lines, lambda ls: let(F.filter(ls, lambda x: F.size(x["words"]) > 0),
                                     lambda worded: let(counts(ls, worded), judged)))


def judge(docs: DataFrame, rules: LineRules = LineRules(), text: str = "text") -> DataFrame:
    """``docs`` with the ``FIELDS`` of each text's verdict."""
    own = "_verdict"
    while own in docs.columns:
        own += "_"
    return (docs.withColumn(own, verdict(F.col(text), rules))
            .withColumns({f: F.col(f"{own}.{f}") for f in FIELDS}).drop(own))


def cleaned(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The documents that are kept, with their clean text; same columns as ``docs``.

    A rejected document's verdict is filtered inside its row, so that each text is judged once.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    kept = docs.select(row, F.inline(F.transform(
        F.filter(F.array(verdict(F.col("text"), rules)), lambda v: v["kept"]),
        lambda v: F.struct(v["clean_text"].alias("clean_text")))))
    return kept.select(*[
        F.col("clean_text").alias("text") if c == "text"
        else F.length("clean_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
        else F.col("row").getField(c).alias(c) for c in docs.columns])


# ---------------------------------------------------------------- query

def op2_line_rules(spark, sf_dir) -> DataFrame:
    from holdfast.llm.common import table
    return judge(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_lines", "n_bad_lines", "clean_chars",
        F.md5("clean_text").alias("clean_md5"))


def lines_sql(docs: str, rules: LineRules = LineRules()) -> str:
    """CTEs ``ln`` (lines with verdict) and ``cleaned`` (clean text) over the relation ``docs``."""
    ws, word = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]+"
    phrases = "|".join(FURNITURE)
    return rf"""
ln0 as (select doc_id, coalesce(text, '') as whole,
          unnest(string_split(coalesce(text, ''), chr(10))) as line,
          unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as k from {docs}),
ln1 as (select doc_id, k, line, regexp_matches(line, '{word}') as worded,
          len(regexp_replace(line, '{ws}', '', 'g')) as chars,
          len(line) - len(regexp_replace(line, '{_class(SYMBOLS)}', '', 'g')) as symbols,
          len(line) - len(regexp_replace(line, '{_class(SEPARATORS)}', '', 'g')) as seps,
          regexp_extract_all(line, '{word}') as w from ln0),
ln as (select doc_id, k, line, worded, worded and (
          symbols * 100 > chars * {rules.symbol_pct}
          or not regexp_matches(line, '{SENTENCE_MARK}')
          or (chars >= {rules.shout_chars} and regexp_matches(line, '\p{{Lu}}{{2}}')
              and not regexp_matches(line, '\p{{Ll}}'))
          or (len(line) <= {rules.furniture_chars} and regexp_matches(lower(line), '{phrases}'))
          or (seps >= {rules.separators} and seps * 4 >= len(w))
          or (len(w) >= {rules.repeat_words}
              and len(list_distinct(w)) * 100 < len(w) * {rules.distinct_pct})) as bad from ln1),
cleaned as (select doc_id, coalesce(string_agg(line, chr(10) order by k)
            filter (where not bad), '') as clean_text, count(*) filter (where worded) as n_lines,
            count(*) filter (where bad) as n_bad_lines,
            count(*) filter (where worded) - count(distinct line) filter (where worded)
              as n_dup_lines from ln group by doc_id)"""


def words_sql(docs: str) -> str:
    """CTE ``counted``: words, characters, symbols and repeated words of the relation ``docs``."""
    ws, word = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]+"
    return rf"""
wd as (select doc_id, regexp_extract_all(coalesce(text, ''), '{word}') as w from {docs}),
wn as (select doc_id, unnest(range(len(w) - 4)) as i, w from wd where len(w) > 5),
wh as (select doc_id, i, count(*) over (partition by doc_id, w[i + 1], w[i + 2], w[i + 3], w[i + 4],
         w[i + 5]) as n from wn),
wr as (select doc_id, least(5, coalesce(lead(i) over (partition by doc_id order by i) - i, 5)) as got
         from wh where n > 1),
wt as (select doc_id, sum(got) as n_repeat_words from wr group by doc_id),
counted as (select d.doc_id, len(wd.w) as n_words,
         len(regexp_replace(coalesce(text, ''), '{ws}', '', 'g')) as word_chars,
         len(coalesce(text, '')) - len(regexp_replace(coalesce(text, ''),
           '{_class(SYMBOLS)}', '', 'g')) as n_symbols,
         cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words
         from {docs} d join wd on wd.doc_id = d.doc_id left join wt on wt.doc_id = d.doc_id)"""


def verdict_sql(docs: str, rules: LineRules = LineRules()) -> str:
    """CTE ``verdict``: everything that ``judge`` adds, by doc_id."""
    return rf"""{lines_sql(docs, rules)}, {words_sql(docs)},
verdict as (select *, not base_failed
         and (word_chars - clean_chars) * 100 <= word_chars * {rules.lost_pct} as kept
       from (select *, n_words < 10 or n_repeat_words * 100 > n_words * 20 as base_failed,
               len(regexp_replace(clean_text, '[\x20\x09-\x0D]', '', 'g')) as clean_chars
             from counted join cleaned using (doc_id)))"""


SQL = f"""with {verdict_sql('documents')}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
  n_lines, n_bad_lines, clean_chars, md5(clean_text) as clean_md5 from verdict"""
