from holdfast.llm import templates as T
from tests.llm.helpers import docs_frame, edge_frame

ITEM = ("A train leaves at 9 and Anna walks 12 km to the station near the river. When the train is late by 12 "
        "minutes, how long does Anna wait there?")
SHORT = "Name the capital of France."


def bench(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)) + [(None, ITEM), (99, None), (98, "Too short.")],
                                 "item_id bigint, text string")


def found(spark, texts, *items):
    rows = T.leaks(docs_frame(spark, texts), bench(spark, *items)).collect()
    return {(r.doc_id, r.item_id): r for r in rows}


def test_verbatim_and_capitals(spark):
    texts = [f"Before it. {ITEM} After it.", ITEM.upper(), "x " + ITEM.replace(" ", "\n", 3), "Nothing of the kind here."]
    got = found(spark, texts, ITEM)
    assert {k[0] for k in got if k[0] != 1} == {0, 2} and got[0, 0].n_changed == 0
    assert (1, 0) not in got or got[1, 0].n_windows >= T.MIN_WINDOWS


def test_other_numbers_names_and_units(spark):
    other = ITEM.replace("Anna", "Mary Jones").replace("12", "7").replace("km", "miles").replace("9", "10")
    got = found(spark, [other], ITEM)
    assert got[0, 0].n_changed >= 5 and got[0, 0].n_windows == got[0, 0].item_windows


def test_inconsistent_slots_do_not_match(spark):
    mixed = ITEM.replace("Anna walks", "Anna walks").replace("does Anna", "does Robert")
    twelve = ITEM.replace("12 km", "7 km").replace("12 minutes", "8 minutes")
    assert found(spark, [mixed, twelve], ITEM) == {}


def test_short_items_and_repeated_items(spark):
    got = found(spark, ["They ask. Name the capital of Spain. Then go on.", "Name a capital."], SHORT, SHORT)
    assert set(got) == {(0, 0), (0, 1)} and got[0, 0].item_windows == 1


def test_clean_drops_leaks_only(spark):
    docs = docs_frame(spark, [ITEM, "A text that holds no question at all, only prose and more prose.", ""])
    left = T.clean(docs, bench(spark, ITEM))
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {1, 2}


def test_edges(spark):
    frame = edge_frame(spark)
    items = bench(spark, "One two three four five six seven eight nine ten eleven.")
    got = {(r.doc_id, r.item_id) for r in T.leaks(frame, items).collect()}
    assert got == {(1, 0), (6, 0)}
    assert len(T.clean(frame, items).collect()) == len(frame.collect()) - 3
    assert T.leaks(edge_frame(spark, []), items).count() == 0
    assert T.leaks(frame, items.limit(0)).count() == 0


def test_shuffled_join_gives_the_same(spark, monkeypatch, sf):
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    want = sorted(map(tuple, T.leaks(docs, items).collect()))
    monkeypatch.setattr(T, "MOST_WINDOWS", 0)
    assert sorted(map(tuple, T.leaks(docs, items).collect())) == want


def test_long_runs(spark):
    """Repetitions that a recursive matcher would not survive, and a long document beside a short item."""
    texts = ["Anna Berta " * 20_000, "1." * 50_000, "." * 300_000 + "5", "! " * 100_000,
             "word 7 " * 10_000 + "They ask. Name the capital of Spain. Then go on.", "x. " + ITEM]
    got = found(spark, texts, SHORT, ITEM)
    assert set(got) == {(4, 0), (5, 1)}


def test_tokens_equal_the_plain_expression(spark, sf):
    import duckdb

    token = T.TOKEN.replace("'", "''")
    want = duckdb.sql(f"""select doc_id, md5(array_to_string(regexp_extract_all(coalesce(text, ''), '{token}'), '|')) as h
                          from '{sf}/documents.parquet'""").fetchall()
    got = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("doc_id", "text")
    got = got.select("doc_id", T.F.md5(T.F.array_join(T.tokens(T.F.col("text")), "|")).alias("h")).collect()
    assert dict(want) == {r.doc_id: r.h for r in got}
