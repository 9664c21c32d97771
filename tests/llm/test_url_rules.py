import re

from holdfast.llm import url_rules as U

URLS = [None, "", "no scheme", "http://a.org", "http://a.org/", "HTTP://B.EXAMPLE.ORG/es/x?q=1#f",
        "https://example.org/en/12", "https://myexample.org/en/1", "http://x.com/fr/1", "http://x.com/de/",
        "http://x.com/de", "http://com/de/x", "http://É.Com/fr/", "a://b://c.com/fr/", "x?://d.org/es/",
        "http://user@e.org:80/p", "http://f.org?x=/es/", "://g.org/#h", "http://xcom/fr/", "http://example.org/es/"]


def by_hand(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host = re.sub("[A-Z]", lambda c: c[0].lower(), m[1]) if m else ""
    path = m[2] if m else ""
    fits = [(len(d + p), d + p, v) for v, d, p in U.LISTED
            if (host == d or host.endswith("." + d)) and path.startswith(p)]
    _, rule, verdict = max(fits, default=(0, None, None))
    return host, path, rule, verdict


def test_listed_rules(spark):
    frame = spark.createDataFrame([(i, u, 1, "z") for i, u in enumerate(URLS)] + [(0, None, 1, "z")],
                                  "page_id bigint, url string, tokens int, host string")
    rows = U.judge(frame).collect()
    assert len(rows) == len(URLS) + 1
    for r in rows:
        host, path, rule, verdict = by_hand(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or "allow")
    assert U.judge(frame.limit(0)).count() == 0


def test_mined_rules_decide_the_rest(spark):
    rows, i = [], 0
    for k in range(60):
        rows += [(i, f"http://s{k % 7}.shop.example.org/es/casino-{k}"), (i + 1, f"http://n.shop.example.org/news/{k}")]
        i += 2
    rows += [(i, "http://q.net/casino/1"), (i + 1, "http://q.net/news/1"), (i + 2, "http://q.net/news/es/1")]
    got = {r.page_id: r for r in U.judge(spark.createDataFrame(rows, "page_id bigint, url string"),
                                         min_rows=5, min_confidence=0.9).collect()}
    assert got[0].rule == "example.org/es/" and got[0].verdict == "block" and got[0].mined is None
    assert got[i].rule is None and got[i].verdict == "block" and got[i].mined == "p:casino"
    assert got[1].rule == "org/" and got[i + 1].verdict == got[1].verdict == "allow" and got[1].mined is None
    assert got[i + 2].verdict == "block" and got[i + 2].mined == "p:es"  # both words occur in the same listed URLs


def test_open_pages_are_no_evidence(spark):
    """A thousand open pages with a word neither make nor unmake a rule."""
    rows = [(k, f"http://a.example.org/es/w{k}/casino") for k in range(20)]
    rows += [(100 + k, f"http://b.org/news/x{k}") for k in range(20)]
    rows += [(1000 + k, f"http://c{k}.net/casino") for k in range(1000)]
    got = U.judge(spark.createDataFrame(rows, "page_id bigint, url string")).collect()
    assert {r.verdict for r in got if r.page_id >= 1000 or r.page_id < 20} == {"block"}
    assert {r.verdict for r in got if 100 <= r.page_id < 1000} == {"allow"}


def test_rules_of_two_words(spark):
    sets = [(["p:a", "p:b"], True, 50), (["p:a"], False, 40), (["p:b"], False, 40), (["p:a", "p:c"], False, 30)]
    rules, _ = U.mine(spark.createDataFrame(sets, "tokens array<string>, blocked boolean, n bigint"))
    assert [(r.rule, r.n, r.n_block) for r in rules.collect()] == [(["p:a", "p:b"], 50, 50)]


def test_hot_sets_and_words_that_go_together(spark):
    """A set of 10^6 equal URLs, thirty words that never part (2^30 sets if each were an item), and both labels."""
    words = [f"p:w{k:02d}" for k in range(30)]
    sets = [([*words, "p:x"], True, 1_000_000), ([*words, "p:y"], False, 700_000), (["p:x"], False, 900_000)]
    rules, items = U.mine(spark.createDataFrame(sets, "tokens array<string>, blocked boolean, n bigint"))
    assert [(r.rule, r.n, r.n_block) for r in rules.collect()] == [(["p:w00", "p:x"], 1_000_000, 1_000_000)]
    assert {(r.token, r.item) for r in items.collect()} == {(w, "p:w00") for w in words} | {("p:x", "p:x")}
    open_sets = spark.createDataFrame([(["p:w07", "p:x"],), (["p:w07"],), (["p:w01", "p:w02"],)], "tokens array<string>")
    hits = U.matches(open_sets, rules, items).collect()
    assert [(r.tokens, r.mined) for r in hits] == [(["p:w07", "p:x"], "p:w07 p:x")]


def test_very_long_urls_and_tables_without_listed_pages(spark):
    rows = [(1, "http://a.net/" + "x/" * 20_000), (2, "http://" + "a." * 300 + "org/" + "y" * 50_000), (3, None)]
    got = {r.page_id: r.verdict for r in U.judge(spark.createDataFrame(rows, "page_id bigint, url string")).collect()}
    assert got == {1: "allow", 2: "allow", 3: "allow"}
    assert U.judge(spark.createDataFrame(rows[:1], "page_id bigint, url string")).first().rule is None


def test_rules_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r.page_id: r for r in U.op5_url_rules(spark, sf).collect()}
    url = U.F.col("url")
    tokens = {r.page_id: frozenset(r.t) for r in pages.select(
        "page_id", U.tokens_of(U.host_of(url), U.path_of(url), url).alias("t")).collect()}
    listed = {i: by_hand_url(pages, r) for i, r in got.items()}
    known = {i: s for i, s in tokens.items() if listed[i]}
    least = max(5, 0.002 * len(known))
    from itertools import combinations
    rules = []
    every = sorted({t for s in known.values() for t in s})
    frequent = [t for t in every if sum(t in s for s in known.values()) >= least]
    for size in range(1, 5):
        for part in combinations(frequent, size):
            if any(set(r) <= set(part) for r in rules):
                continue
            hit = [i for i, s in known.items() if s.issuperset(part)]
            bad = sum(listed[i] == "block" for i in hit)
            if bad >= least and bad >= 0.9 * len(hit):
                rules.append(part)
    mined = 0
    for i, r in got.items():
        if r.rule is None:
            assert (r.verdict == "block") == any(tokens[i].issuperset(x) for x in rules)
            mined += r.verdict == "block"
    assert mined  # the method decides pages of the given table


def by_hand_url(pages, row):
    hits = [(len(d + p), v) for v, d, p in U.LISTED
            if (row.host == d or row.host.endswith("." + d)) and row.path.startswith(p)]
    return max(hits)[1] if hits else None
