import duckdb

from holdfast.llm import tool_calls as C


def test_rows_without_role_or_turn_are_messages(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes there"), (1, 2, "user", "so"), (1, 3, None, "no role"),
            (1, None, "user", "no turn"), (1, None, "assistant", "neither"), (2, None, None, None), (2, -1, "user", "early")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = C.formatted(*C.derived(frame), C.TOOLS).collect()
    assert len(got) == len(rows)
    texts = {r.json for r in got if r.kind == 0}
    assert len(texts) == 6 and '{"content":"no role","role":null}' in texts
    assert '{"content":"neither","role":"assistant"}' in texts


def test_sql_has_every_row(spark):
    """Rows without role, turn, conversation or text, repeated rows, circles and a chain of 60 calls."""
    rows = [(1, 0, "user", "hi"), (1, None, "assistant", "x"), (None, 3, "assistant", "ab"), (None, 4, "user", "r"),
            (2, 1, None, None), (3, 1, "assistant", "abcde"), (3, 3, "assistant", "abcdef"), (3, 5, "assistant", "abcdefg"),
            (4, 1, "assistant", "abc"), (4, 1, "assistant", "abcd"), (4, 1, "assistant", "abcde"), (4, 2, "user", "q"),
            (4, 2, "user", "q"), (5, 7, "assistant", None), (5, 9, "assistant", ""), (6, -2, "user", "e")]
    rows += [(7, t, "assistant", "long text." * 3) for t in range(1, 120, 2)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    columns = ["conv_id", "anchor", "step", "kind", "turn", "call_id", "status", "problems", "json"]
    made = C.formatted(*C.derived(frame), C.TOOLS).selectExpr(
        *[c if c != "problems" else "array_join(problems, ';') as problems" for c in columns]).collect()
    conversations = frame.toArrow()  # noqa: F841  read by name
    sql = duckdb.connect()
    sql.register("conversations", conversations)
    wanted = sql.sql(f"select {', '.join(columns)} from ({C.SQL})").fetchall()
    assert sorted(map(repr, map(tuple, made))) == sorted(map(repr, wanted))
    assert any(r[2] > 40 for r in wanted)
