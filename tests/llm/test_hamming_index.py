import numpy as np
import pytest

from holdfast.llm import hamming_index as N

SCHEMA = "vec_id bigint, embedding array<float>"


def brute(rows, top=5, every=50):
    """Every query against every row, in double precision."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(np.float64)
    norm = np.sqrt((x * x).sum(axis=1))
    out = {}
    for k in np.flatnonzero(ids % every == 0):
        score = (x * x[k]).sum(axis=1) / (norm * norm[k])
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[k]][:top]
        out[int(ids[k])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def answers(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    hit = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in v}) for q, v in want.items())
    return hit / sum(map(len, want.values()))


def check_scores(got, rows):
    by = {i: np.array(v, np.float32).astype(np.float64) for i, v in rows}
    for q, found in got.items():
        assert q not in [i for i, _ in found]
        for i, s in found:
            a, b = by[q], by[i]
            assert abs(s - (a @ b) / (np.sqrt(a @ a) * np.sqrt(b @ b))) < 1e-12
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_query_recall_against_brute_force(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got, want = answers(N.op12_multi_index_hashing(spark, folder)), brute(rows)
    check_scores(got, rows)
    assert {q: len(v) for q, v in got.items()} == {q: len(v) for q, v in want.items()}
    assert recall(got, want) >= 0.9


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 1 << 16, (3000, 16), np.uint16)
    centre = codes[0].copy()
    for k in range(1, 400):  # codes up to 60 bits away from the first one
        bits = rng.choice(256, rng.integers(0, 60), replace=False)
        codes[k] = centre
        for b in bits:
            codes[k, b // 16] ^= np.uint16(1 << (b % 16))
    index, away = N.Index(codes), None
    away = index.distances(centre)
    assert away[0] == 0 and (away == np.array([bin(int.from_bytes((c ^ centre).tobytes())).count("1") for c in codes])).all()
    seen = set()
    for t in range(N.MOST_PROBED + 1):
        seen |= set(index.probe(centre, t).tolist())
        assert set(np.flatnonzero(away <= 16 * (t + 1) - 1).tolist()) <= seen
    near = set(index.near(centre, 50).tolist())
    radius = max(away[list(near)])
    assert near == set(np.flatnonzero(away <= radius).tolist()) or near == set(np.flatnonzero(away <= 31).tolist())
    lonely = rng.integers(0, 1 << 16, 16, np.uint16)
    far = index.distances(lonely)
    assert set(index.near(lonely, 50).tolist()) == set(np.flatnonzero(far <= np.sort(far)[49]).tolist())


def test_blocks_and_parts_give_the_same(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((30, 24))
    rows = [(i, (base[i % 30] + 0.2 * rng.standard_normal(24)).astype(np.float32).tolist()) for i in range(1200)]
    frame = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    whole = answers(N.nearest(frame))
    cut = answers(N.nearest(frame, block=150, part=5))
    check_scores(whole, rows)
    check_scores(cut, rows)
    assert recall(whole, want) >= 0.9 and recall(cut, want) >= 0.97


def test_copies_and_ties(spark):
    rng = np.random.default_rng(5)
    hot = rng.standard_normal(16).astype(np.float32).tolist()
    rows = [(i, hot if i % 3 else rng.standard_normal(16).astype(np.float32).tolist()) for i in range(600)]
    rows += [(600 + i, [2 * x for x in hot]) for i in range(3)]
    got, want = answers(N.nearest(spark.createDataFrame(rows, SCHEMA))), brute(rows)
    for q in (50, 100, 200, 250):  # queries of the hot vector: the smallest ids, but for the own
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]] == [1, 2, 4, 5, 7]
    assert recall(got, want) >= 0.9


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (50, [0.0, 1.0]), (1, [1.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]),
            (5, [inf, 1.0]), (6, [None, 1.0]), (7, []), (8, [1.0, 2.0, 3.0]), (None, [1.0, 0.5]), (9, [-1.0, 0.0]),
            (100, [None, None]), (10, [3.0e38, 1.0e-30]), (150, [1.0e-40, 0.0])]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", *[f"1 as `{c}`" for c in (
        "n k1 k2 rep ids asks ask block part score rank query_id _at label").split()])
    got = answers(N.nearest(frame))
    assert set(got) == {0, 50, 150}
    assert [i for i, _ in got[0]] == [10, 150, 1, 50, 9] and abs(got[0][0][1] - 1) < 1e-12
    assert [i for i, _ in got[50]][0] == 1 and {i for i, _ in got[50]} == {0, 1, 9, 10, 150}
    assert N.nearest(frame.limit(0)).count() == 0
    assert N.nearest(frame.filter("vec_id = 3")).count() == 0
    one = N.nearest(frame.filter("vec_id = 50"))
    assert one.count() == 0 and one.columns == ["query_id", "rank", "vec_id", "score"]
