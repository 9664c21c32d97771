import zlib

import numpy as np

from holdfast.llm import toxicity as T


def test_thresholds_follow_all_labelled_rows(spark):
    """A language with few rows in any sample, but enough labelled ones, gets its own threshold from all of them."""
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(4000):
        lang, toxic = "xx" if i % 50 == 0 else "en", int(rng.random() < 0.3)
        score = (0.15 if lang == "xx" else 0.6) * (0.4 + 0.6 * toxic) + rng.random() * 0.05
        rows.append((i, lang, float(score)))
        labels.append((i, toxic))
    model = T.Model({}, np.zeros(1), np.zeros(1), 0.0)
    T.set_thresholds(model, spark.createDataFrame(rows, "doc_id bigint, lang string, score double"),
                     spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    assert set(model.thresholds) == {"en", "xx"}

    def f1(own, cut):
        hit = sum(s >= cut and y for s, y in own)
        return 2 * hit / (sum(s >= cut for s, _ in own) + sum(y for _, y in own))

    for lang, cut in model.thresholds.items():
        own = [(s, y) for (i, x, s), (_, y) in zip(rows, labels)
               if x == lang and zlib.crc32(str(i).encode()) % 5]
        assert f1(own, cut) >= max(f1(own, k / T.BINS) for k in range(T.BINS)) - 1e-12


def test_flags_use_the_language_threshold(spark):
    model = T.Model({}, np.zeros(1), np.zeros(1), 0.0, thresholds={"xx": 0.2}, threshold=0.6)
    scores = spark.createDataFrame([(1, "xx", False, 0.3), (2, "en", False, 0.3), (3, None, True, 0.7)],
                                   "doc_id bigint, lang string, held_out boolean, score double")
    got = {r.doc_id: (r.predicted, r.threshold, r.flagged) for r in T.judged(scores, model).collect()}
    assert got == {1: (0, 0.2, True), 2: (0, 0.6, False), 3: (1, 0.6, True)}


def test_copies_of_a_chosen_id_are_one_row_of_the_sample(spark):
    docs = spark.createDataFrame([(3, f"text {i % 7}", "en") for i in range(500)] + [(4, "other", None), (4, None, "en")],
                                 "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(3, 1), (3, 1), (4, 0)], "doc_id bigint, toxic int")
    ids = {i for i in (3, 4) if zlib.crc32(str(i).encode()) % 5}
    rows, share = T.sample(docs, labels)
    assert sorted(rows) == sorted(r for i, r in ((3, ("text 0", 1, "en")), (4, ("other", 0, None))) if i in ids)
    assert len(ids) and all(s <= 1 for s in share)
