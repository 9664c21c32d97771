from holdfast.llm import templates as T
from tests.llm.helpers import docs_frame


def test_items_of_numbers_and_short_items_are_found(spark):
    items = ["What is 12 x 13 + 7?", "17 + 25 = ?", "Name the capital of France.", "Anna Smith buys 3 red apples.",
             " ".join(str(k * k) for k in range(40)), "How many legs do 3 cats and 4 dogs have?"]
    texts = ["Try this: What is 12 x 13 + 7? Then rest.", "so 17 + 25 = ? is easy", "Quiz: Name the capital of Spain.",
             "He wrote \"Anna Smith buys 3 red apples.\" there", "squares " + items[4] + " end",
             "quiz - How many legs do 5 cats and 6 dogs have? Tell me.",
             "What is 12 x 13 + 8?", "from 17 - 25 = ? on", "How many legs do 3 birds have?", "",
             ("Then we ask. " + items[3])]
    benchmark = spark.createDataFrame(list(enumerate(items)) + [(None, "1 2"), (9, ""), (8, None)],
                                      "item_id bigint, text string")
    rows = {(r.doc_id, r.item_id): r for r in T.leaks(docs_frame(spark, texts), benchmark).collect()}
    assert set(rows) == {(0, 0), (1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (10, 3)}
    assert rows[5, 5].n_changed == 2 and rows[0, 0].n_changed == 0
