import pytest
from pyspark.sql import functions as F

from holdfast.operators.upsert import band_monotonicity, change_counts, merge_scores
from holdfast.sources.versioned import Conflict, Versioned, bucket_of
from holdfast.streaming import score_refresh

SCHEMA = "customer_id string, churn_probability double, risk_band string"


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([
        ("null-score", None, None), ("same", 0.5, "High"), ("moved", 0.1, "Low"),
        ("band-only", 0.3, "Low"), ("null-band", 0.3, None), ("unmatched", 0.9, "High")], SCHEMA)


@pytest.fixture(scope="module")
def updates(spark):
    return spark.createDataFrame([
        ("null-score", 0.4, "Medium"), ("same", 0.5, "High"), ("moved", 0.2, "Medium"),
        ("band-only", 0.3, "Medium"), ("null-band", 0.3, "Medium"), ("new", 0.7, "High")], SCHEMA)


def test_only_matched_and_changed_rows_move(target, updates):
    got = {r["customer_id"]: tuple(r)[1:] for r in merge_scores(target, updates).collect()}
    assert got == {
        "null-score": (0.4, "Medium", True), "same": (0.5, "High", False),
        "moved": (0.2, "Medium", True), "band-only": (0.3, "Medium", True),
        "null-band": (0.3, None, False),  # comparison with NULL is unknown
        "unmatched": (0.9, "High", False)}


def test_change_counts(target, updates):
    merged = merge_scores(target, updates)
    assert [tuple(r) for r in change_counts(merged).collect()] == [("UPDATE", 3)]
    again = merge_scores(merged.drop("changed"), updates)
    assert change_counts(again).count() == 0


def test_band_order_check(spark):
    df = spark.createDataFrame([("High", 0.9, 1), ("Low", 0.1, 0), ("Medium", 0.4, 0)],
                               "risk_band string, churn_probability double, churn_flag int")
    assert all(r["monotonic"] for r in band_monotonicity(df).collect())
    bad = df.withColumn("churn_flag", 1 - F.col("churn_flag"))
    assert not all(r["monotonic"] for r in band_monotonicity(bad).collect())


def test_equally_late_updates_have_one_winner(spark):
    rows = [("a", 0.2, "Medium", 5), ("a", 0.7, "High", 5), ("a", 0.9, "High", 1), ("b", None, None, 2)]
    df = spark.createDataFrame(rows, SCHEMA + ", scored_at int")
    for frame in (df, df.orderBy("churn_probability"), df.repartition(3)):
        got = {tuple(r) for r in score_refresh.latest_scores(frame, "customer_id", "scored_at").collect()}
        assert got == {("a", 0.7, "High"), ("b", None, None)}


def test_stream_merges_each_batch_once(spark, target, tmp_path):
    root, feed, progress = (str(tmp_path / n) for n in ("versions", "feed", "progress"))
    table = Versioned.create(target, root, "customer_id", 3)
    schema = SCHEMA + ", scored_at int"
    spark.createDataFrame([("same", 0.6, "High", 1), ("same", 0.7, "High", 2)], schema).write.parquet(feed)
    stream = lambda: spark.readStream.schema(schema).parquet(feed)

    def run():
        q = score_refresh.refresh(stream(), root, progress).start()
        q.awaitTermination()

    run()
    spark.createDataFrame([("moved", 0.2, "Medium", 3)], schema).write.mode("append").parquet(feed)
    run()
    run()  # nothing new: no further version
    got = {r["customer_id"]: r["churn_probability"] for r in table.read().collect()}
    assert got["same"] == 0.7 and got["moved"] == 0.2 and len(got) == 6
    assert table.versions() == [0, 1, 2]
    assert table.manifest()["applied"] == {progress: 1}


def test_a_repeated_batch_changes_nothing(spark, target, updates, tmp_path):
    table = Versioned.create(target, str(tmp_path / "t"), "customer_id", 4)
    first = table.merge(updates, merge_scores, "feed", 0)
    assert first and table.merge(updates, merge_scores, "feed", 0) == []
    assert table.versions() == [0, 1]
    assert table.merge(updates, merge_scores) == []  # known rows under no number: nothing differs
    assert table.versions() == [0, 1]
    want = {tuple(r) for r in merge_scores(target, updates).drop("changed").collect()}
    assert {tuple(r) for r in table.read().collect()} == want


def test_a_batch_that_touches_one_bucket_writes_one(spark, tmp_path):
    rows = spark.range(2000).selectExpr("cast(id as string) as customer_id", "0.1D as churn_probability", "'Low' as risk_band")
    table = Versioned.create(rows, str(tmp_path / "t"), "customer_id", 16)
    before = table.manifest()["folders"]
    one = rows.where(bucket_of("customer_id", 16) == 5).withColumn("churn_probability", F.lit(0.9))
    assert table.merge(one, merge_scores) == ["5"]
    after = table.manifest()["folders"]
    assert {b for b in after if after[b] != before[b]} == {"5"} and len(after) == 16
    assert table.read().where("churn_probability = 0.9").count() == one.count()
    assert table.read().count() == 2000


def test_a_reader_keeps_its_version(spark, target, updates, tmp_path):
    table = Versioned.create(target, str(tmp_path / "t"), "customer_id", 2)
    old = {tuple(r) for r in target.collect()}
    with table.reading() as seen:
        changed = table.merge(updates, merge_scores)
        assert changed and table.vacuum() == []  # the reader needs the old folders
        assert {tuple(r) for r in seen.collect()} == old
        assert {tuple(r) for r in table.read().collect()} != old
    assert len(table.vacuum()) == len(changed) and table.versions() == [1]
    assert table.vacuum() == [] and table.read().count() == 6


def test_a_reader_that_never_ended_does_not_hold_for_ever(spark, target, updates, tmp_path):
    table = Versioned.create(target, str(tmp_path / "t"), "customer_id", 2)
    lost = table.reading()
    lost.__enter__()
    changed = table.merge(updates, merge_scores)
    assert table.vacuum() == [] and len(table.vacuum(reader_hours=0)) == len(changed)


def test_two_writers_cannot_both_store_a_version(spark, target, updates, tmp_path):
    table = Versioned.create(target, str(tmp_path / "t"), "customer_id", 2)

    def slow(rows, new):
        if table.versions() == [0]:  # another writer is faster
            Versioned(spark, table.root).merge(new, merge_scores)
        return merge_scores(rows, new)

    with pytest.raises(Conflict):
        table.merge(updates.limit(6), lambda rows, new: slow(rows, new).withColumn("changed", F.lit(True)))
    assert table.versions() == [0, 1]
    with pytest.raises(Conflict):
        Versioned.create(target, table.root, "customer_id")


def test_empty_table_and_empty_updates(spark, target, updates, tmp_path):
    table = Versioned.create(target.limit(0), str(tmp_path / "t"), "customer_id", 2)
    assert table.merge(updates, merge_scores) == [] and table.read().count() == 0
    table = Versioned.create(target, str(tmp_path / "u"), "customer_id", 2)
    assert table.merge(updates.limit(0), merge_scores) == [] and table.versions() == [0]
