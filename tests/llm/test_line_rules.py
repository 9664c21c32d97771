from holdfast.llm import line_rules
from tests.llm.helpers import EDGES, WORD, edge_frame, repeated_words


def by_hand(text):
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    again = repeated_words(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), again, len(words) < 10 or 100 * again > 20 * len(words))


def test_base_counts_match_plain_python(spark):
    got = line_rules.judge(edge_frame(spark)).collect()
    assert len(got) == len(EDGES)
    for row in got:
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words,
                row.base_failed) == by_hand(row.text)
        assert not (row.base_failed and row.kept)


def test_repeated_windows(spark):
    texts = ["a b c d e f", "a b c d e a b c d e", "a a a a a a", "a b c d e x a b c d e y a b c d e",
             "p q r s t u v p q r s t u v w", "a b c d", ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.n_repeat_words for r in line_rules.judge(frame).collect()}
    assert got == {i: repeated_words(t.split()) for i, t in enumerate(texts)}


def test_lines_are_judged_and_removed(spark):
    good = "This is a sentence of plain prose, and it ends here."
    other = "Here comes another one; nothing in it is like the first."
    bad = ["Home | News | Sport | Contact | Shop", "### *** $$$ %%% word.", "BUY NOW AND SAVE A LOT!!",
           "spam spam spam spam spam spam spam spam spam spam spam spam.", "All rights reserved.",
           "no mark at all in this line"]
    frame = spark.createDataFrame([(1, "\n".join([good, bad[0], other, "", bad[1]]), "en"),
                                   (2, "\n".join(bad), "en")], "doc_id bigint, text string, lang string")
    rows = {r.doc_id: r for r in line_rules.judge(frame).collect()}
    assert rows[1].clean_text == good + "\n" + other + "\n" and rows[1].n_bad_lines == 2
    assert rows[1].kept and rows[2].n_bad_lines == len(bad) and not rows[2].kept
    left = line_rules.cleaned(frame)
    assert left.columns == frame.columns and [r.doc_id for r in left.collect()] == [1]


def test_cleaned_keeps_columns_and_survives_edges(spark):
    frame = edge_frame(spark)
    left = line_rules.cleaned(frame)
    assert left.columns == frame.columns and left.schema == frame.schema
    rows = left.collect()
    assert sorted((r.doc_id or 0) for r in rows) == [0, 1, 6, 6]
    assert all(r.n_chars == len(r.text) and r.n_words == 1 for r in rows)
    assert line_rules.cleaned(edge_frame(spark, [])).count() == 0


def test_sentences_of_other_scripts_stay(spark):
    lines = ["这 是 一 个 完整 的 句子。", "他 明天 还 会 来 吗？",
             "यह एक वाक्य है।", "هل هذا صحيح ؟",
             "և այսպես եղավ։"]
    bare = "这 是 没有 句号 的 行"
    frame = spark.createDataFrame([(1, "\n".join([*lines, bare]), "mine")], "doc_id bigint, text string, _verdict string")
    row = line_rules.judge(frame).first()
    assert row.clean_text == "\n".join(lines) and row.n_bad_lines == 1 and row.kept
    assert row["_verdict"] == "mine"
