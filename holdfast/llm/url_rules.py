"""URL filters: a rule list, and association rules mined from labelled URLs.

A URL is a set of tokens (host suffixes, path words, query keys). The labels are the verdicts of the listed rules, and
only URLs that one of them decides are learned from. Spark's FP-growth finds token sets that occur often enough,
once with and once without the label; a set whose share of blocked URLs reaches ``min_confidence`` is a rule, and a
rule that contains another is redundant and dropped. Rules match by an inverted index: each rule is filed under its
rarest token, a URL looks up its tokens there, and a hit counts if the URL has all tokens of the rule. The mined
rules decide the URLs that no listed rule fits.

Only DataFrame operations and Spark's own FP-growth. What cannot be in a rule is left out before the mining,
without losing one: tokens in too few blocked URLs, and tokens that are a rule by themselves. Tokens that
occur in exactly the same URLs are one item. Each remaining set of k tokens that is frequent has 2^k frequent subsets;
so many are enumerated. Equal sets are counted before, and dealt to tasks in pieces of bounded size, so that neither a
hot host nor a hot path meets in one task. Open URLs are matched through their distinct token sets; these are sent
to all tasks if they proved few, and joined with skew handling otherwise.

Defined results: a NULL URL or one without ``://`` has an empty host and path, no rule and no tokens, and is
allowed. Repeated rows are judged each. Among listed rules the longest wins. An empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import stored, table
from holdfast.session import cut_measured, fits_broadcast

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed list: verdict, and host and path of the rule.
LISTED = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
          ("allow", "com", "/fr/"), ("block", "com", "/de/"))
LABEL = "=block"  # the label as an item; tokens never begin with '='
PIECE = 1000  # URLs of one token set that a row stands for at most while they are dealt to the mining tasks


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, in small ASCII letters."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1),
                       UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the host's end to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def listed_rule(host: Column, path: Column, rules=LISTED) -> tuple[Column, Column]:
    """Text and verdict of the longest listed rule that fits, NULL without one."""
    def first(value):
        found = F.lit(None).cast("string")
        for verdict, domain, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
            fits = (((host == domain) | host.endswith("." + domain)) & path.startswith(start))
            found = F.when(fits, F.lit(value(verdict, domain, start))).otherwise(found)
        return found

    return first(lambda v, d, p: d + p), first(lambda v, d, p: v)


def tokens_of(host: Column, path: Column, url: Column) -> Column:
    """Sorted set of tokens: each suffix of the host from its second level on (``h:``), words of the path
    (``p:``), keys of the query (``q:``)."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    suffixes = F.when(F.size(labels) > 0, F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda k: F.concat(F.lit("h:"), F.array_join(
            F.slice(labels, k, F.size(labels)), ".")))).otherwise(F.array().cast("array<string>"))
    words = F.transform(F.filter(F.split(path, r"[/._-]"), lambda x: x.rlike("[^0-9]")),
                        lambda x: F.concat(F.lit("p:"), F.lower(x)))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)://[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""),
                       lambda x: F.concat(F.lit("q:"), F.regexp_extract(x, "^[^=]*", 0)))
    return F.array_sort(F.array_distinct(F.concat(suffixes, words, keys)))


def items_of(labelled: DataFrame, least: float, min_confidence: float) -> tuple[DataFrame, DataFrame]:
    """Items (token, item, n, n_block, alone) that can be in a rule: the first token of those that occur in exactly the
    same sets stands for all; ``alone`` if it is a rule by itself. At most tokens per URL / support of them are left."""
    seen = labelled.select("n", "blocked", *[F.xxhash64("tokens", "blocked", F.lit(k)).alias(f"h{k}") for k in (1, 2)],
                           F.explode("tokens").alias("token"))
    counted = seen.groupBy("token").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("blocked"), F.col("n")).otherwise(0)).alias("n_block"),
        F.bit_xor("h1").alias("x"), F.bit_xor("h2").alias("y"))
    useful = stored(counted.filter(F.col("n_block") >= least), "tokens")
    first = useful.groupBy("n", "n_block", "x", "y").agg(F.min("token").alias("item"))
    alone = F.col("n_block") >= F.col("n") * min_confidence
    return stored(useful.join(first, ["n", "n_block", "x", "y"]).select("token", "item", "n", "n_block",
                                                                      alone.alias("alone")), "items")


def as_items(sets: DataFrame, items: DataFrame) -> DataFrame:
    """``tokens`` of each set that has some, with its items and for each the first token that it stands for."""
    fixed = F.broadcast(items) if fits_broadcast(items) else items
    own = (sets.select("tokens", F.explode("tokens").alias("token")).join(fixed, "token")
           .groupBy("tokens", "item").agg(F.min("token").alias("token")))
    return own.groupBy("tokens").agg(F.map_from_entries(F.collect_list(F.struct("item", "token"))).alias("own"))


def mine(labelled: DataFrame, min_support: float = 0.002, min_rows: int = 5,
         min_confidence: float = 0.9) -> tuple[DataFrame, DataFrame]:
    """Rules (rule array of items, n, n_block) and the tokens of each item, from rows (tokens array, blocked
    boolean, n); ``n`` is how many URLs share the token set and label.

    A rule's set occurs in at least ``min_support`` of the labelled URLs and in ``min_rows`` URLs, blocked ones.
    """
    total = labelled.agg(F.sum("n")).first()[0] or 0
    least = max(min_support * total, min_rows)
    items = items_of(labelled, least, min_confidence)
    single = items.filter("alone").select(F.array("item").alias("rule"), "n", "n_block").distinct()
    known = as_items(labelled.select("tokens").distinct(), items.filter("not alone").drop("n"))
    parts = (labelled.join(known, "tokens")
             .groupBy(F.array_sort(F.map_keys("own")).alias("items"), "blocked").agg(F.sum("n").alias("n")))
    parts = stored(parts, "transactions")
    pieces = parts.select(
        F.when(F.col("blocked"), F.array_append("items", F.lit(LABEL))).otherwise(F.col("items")).alias("items"), "n",
        F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / PIECE))).alias("piece"))
    spread = (pieces.repartition(max(8, -(-total // 1_000_000)))
              .select(F.explode(F.array_repeat("items", F.least(
                  F.lit(PIECE), F.col("n") - F.col("piece") * PIECE).cast("int"))).alias("items")))
    rows = parts.agg(F.sum("n")).first()[0] or 0
    sets = FPGrowth(itemsCol="items", minSupport=min(1.0, least * (1 - 1e-9) / max(1, rows))).fit(spread).freqItemsets
    sets = stored(sets.select(F.array_sort("items").alias("items"), "freq"), "itemsets")
    blocked = (sets.filter(F.array_contains("items", LABEL) & (F.size("items") > 2))
               .select(F.array_remove("items", LABEL).alias("rule"), F.col("freq").alias("n_block")))
    several = (blocked.join(sets.select(F.col("items").alias("rule"), F.col("freq").alias("n")), "rule")
               .filter(F.col("n_block") >= F.col("n") * min_confidence).select("rule", "n", "n_block"))
    rules = stored(single.unionByName(several), "rules")
    # a rule is redundant if one item less is a rule as well
    shorter = rules.select("rule", F.explode("rule").alias("less")).select(
        "rule", F.array_remove("rule", F.col("less")).alias("part"))
    covered = shorter.join(rules.select(F.col("rule").alias("part")), "part", "left_semi")
    return rules.join(covered.select("rule"), "rule", "left_anti"), items


def matches(sets: DataFrame, rules: DataFrame, items: DataFrame) -> DataFrame:
    """Token sets (column ``tokens``) that some rule fits, with the first such rule's text."""
    known = stored(as_items(sets, items), "open-sets")
    counted = (rules.select("rule", F.explode("rule").alias("item"))
               .join(known.select(F.explode(F.map_keys("own")).alias("item")).groupBy("item")
                     .agg(F.count("*").alias("n_sets")), "item"))
    index = (counted.groupBy("rule").agg(F.min(F.struct("n_sets", "item")).alias("rarest"))
             .select("rule", F.col("rarest.item").alias("item")))
    return (known.select("tokens", "own", F.explode(F.map_keys("own")).alias("item")).join(index, "item")
            .filter(F.size(F.array_except("rule", F.map_keys("own"))) == 0)
            .groupBy("tokens").agg(F.min(F.array_join(F.array_sort(F.transform(
                "rule", lambda x: F.element_at("own", x))), " ")).alias("mined")))


def judge(urls: DataFrame, min_support: float = 0.002, min_rows: int = 5,
          min_confidence: float = 0.9) -> DataFrame:
    """``page_id, host, path, rule, verdict, mined``.

    Learns from the URLs that the list decides; the mined rules decide those that it says nothing about.
    """
    url = F.col("url")
    parts = urls.select("page_id", url, host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = listed_rule(F.col("host"), F.col("path"))
    parts = parts.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("listed"),
                         tokens_of(F.col("host"), F.col("path"), url).alias("tokens"))
    seen = stored(parts.filter(F.size("tokens") > 0).groupBy("tokens", "listed").agg(F.count("*").alias("n")), "token-sets")
    rules, items = mine(seen.filter("listed is not null").select(
        "tokens", (F.col("listed") == "block").alias("blocked"), "n"), min_support, min_rows, min_confidence)
    hits, few = cut_measured(matches(seen.filter("listed is null").select("tokens"), stored(rules, "mined-rules"), items))
    return (parts.join(F.broadcast(hits) if few else hits, "tokens", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("listed", F.when(F.col("mined").isNotNull(), "block").otherwise("allow"))
                    .alias("verdict"),
                    F.when(F.col("listed").isNull(), F.col("mined")).alias("mined")))


# ---------------------------------------------------------------- query

def op5_url_rules(spark, sf_dir) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
