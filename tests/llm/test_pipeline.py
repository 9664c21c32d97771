import corpus_pipeline as P
from tests.llm import helpers as H
from tests.llm.test_near_duplicates import brute_join, brute_lines
from tests.llm.test_packing import check_layout, check_pieces, tokenizer  # noqa: F401

from holdfast.llm import templates
from holdfast.llm.common import stored, table


def test_run_against_brute_force(spark, sf, tokenizer):  # noqa: F811
    raw = table(spark, sf, "documents")
    docs = P.quality_rules(spark, raw, sf)
    texts = {r.doc_id: r.text for r in docs.collect()}
    gone = brute_lines(texts)
    lines = {}
    for i, text in texts.items():
        parts = [x for k, x in enumerate(text.split("\n")) if k not in gone.get(i, [])]
        if i not in gone or any(H.WORD.search(x) for x in parts):
            lines[i] = "\n".join(parts)
    firsts = {i: lines[i] for i, v in brute_join(lines).items() if v[0] == i}
    frame = spark.createDataFrame(list(firsts.items()), "doc_id bigint, text string")
    leaks = {r.doc_id for r in templates.leaks(frame, table(spark, sf, "benchmark")).collect()}
    want = {i: t for i, t in firsts.items() if i not in leaks}
    rows = P.run(spark, sf).collect()
    check_pieces(rows, want, tokenizer)
    check_layout(rows)


def test_stages_keep_the_columns_and_survive_edges(spark, sf):
    docs = H.edge_frame(spark)
    columns = docs.columns
    for name, stage in P.STAGES[:-1]:
        docs = stored(stage(spark, docs, sf), "edge")
        assert docs.columns == columns, name
    assert {r.doc_id for r in docs.collect()} == {None, 1}
    assert P.best_fit_packing(spark, docs, sf).count() == 2
    empty = H.edge_frame(spark, [])
    for _, stage in P.STAGES[:-1]:
        assert stage(spark, empty, sf).count() == 0
