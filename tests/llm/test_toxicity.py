import zlib

import numpy as np

from holdfast.llm import toxicity as T
from tests.llm.helpers import EDGES, LONG, edge_frame


def auc(score, label):
    rank = np.argsort(np.argsort(score)) + 1
    n1 = label.sum()
    return (rank[label == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(label) - n1))


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    rows = T.op6_toxicity_cnn(spark, d).collect()
    assert len({r.doc_id for r in rows}) == len(rows) == spark.read.parquet(f"{d}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) and r.flagged == (r.score >= r.threshold)
    own = [r for r in rows if r.held_out and r.doc_id in labels]
    score, label = np.array([r.score for r in own]), np.array([labels[r.doc_id] for r in own])
    assert auc(score, label) > 0.94 and ((score >= 0.5) == label).mean() > 0.95


def test_scores_do_not_depend_on_blocks_or_language():
    rng = np.random.default_rng(0)
    tables = {(w, j): rng.normal(size=(T.BUCKETS, T.FILTERS)).astype(np.float32)
              for w in T.WIDTHS for j in range(w)}
    n = T.FILTERS * len(T.WIDTHS)
    model = T.Model(tables, rng.normal(size=n), rng.normal(size=n), 0.1)
    words = T.buckets(LONG[:3000] + " other words. " + LONG[:500])
    whole = model.pooled(words)
    assert np.allclose(whole, model.pooled(words, block=7))
    vectors = {k: v[words] for k, v in tables.items()}
    length = len(words) - max(T.WIDTHS) + 1
    plain = np.concatenate([sum(vectors[w, j][j:length + j] for j in range(w)).max(axis=0) for w in T.WIDTHS])
    assert np.allclose(whole, np.maximum(plain + model.bias, 0), atol=1e-5)


def test_training_step_follows_the_numeric_gradient():
    rng = np.random.default_rng(1)
    n = T.FILTERS * len(T.WIDTHS)

    def fresh():
        r = np.random.default_rng(2)
        return {"emb": r.normal(0, 1, (T.BUCKETS, T.DIM)), "bias": r.normal(0, 1, n), "out": r.normal(0, 1, n),
                "kernels": [r.normal(0, 1, (w, T.DIM, T.FILTERS)) for w in T.WIDTHS], "intercept": 0.1}

    words, toxic, weight = [rng.integers(1, 50, 12) for _ in range(3)], np.array([1.0, 0, 1]), np.ones(3)

    def loss(m):
        total = 0
        for w, y in zip(words, toxic):
            v = m["emb"][w]
            k = len(w) - max(T.WIDTHS) + 1
            pooled = np.concatenate([sum(v[j:k + j] @ c[j] for j in range(len(c))).max(axis=0) for c in m["kernels"]])
            z = np.maximum(pooled + m["bias"], 0) @ m["out"] + m["intercept"]
            total += np.logaddexp(0, z) - y * z
        return total / len(words)

    rate, model = 1e-3, fresh()
    T._step(model, words, toxic, weight, rate, 0.0)
    start = fresh()
    for name, at in (("bias", 3), ("out", 5)):
        up = fresh()
        up[name][at] += 1e-5
        slope = (loss(up) - loss(start)) / 1e-5
        assert abs((start[name][at] - model[name][at]) / rate - slope) < 1e-3
    up, word = fresh(), int(words[0][4])
    up["emb"][word, 2] += 1e-6
    slope = (loss(up) - loss(start)) / 1e-6
    assert abs((start["emb"][word, 2] - model["emb"][word, 2]) / rate - slope) < 1e-2


def test_edges(spark):
    labels = spark.createDataFrame([(1, 1, 1), (5, 1, 0), (7, 0, None), (None, 1, 1), (8, 1, 5)],
                                   "doc_id bigint, quality int, toxic int")
    rows = T.classify(edge_frame(spark), labels).collect()
    assert len(rows) == len(EDGES) and all(0 <= r.score <= 1 for r in rows)
    empty = {r.score for r in rows if r.doc_id in (2, 3, 4)}
    assert len(empty) == 1
    assert {r.score for r in T.classify(edge_frame(spark), labels.limit(0)).collect()} == {0.5}
    assert T.classify(edge_frame(spark, []), labels).count() == 0


def test_threshold_has_the_best_f1():
    score, label = np.array([0.1, 0.4, 0.4, 0.6, 0.9]), np.array([0, 0, 1, 1, 1.0])
    cut = T._best_threshold(score, label)
    assert cut < 0.4
    assert T._best_threshold(np.array([0.2, 0.3, 0.7, 0.8]), np.array([0, 0, 1.0, 1])) == 0.5
