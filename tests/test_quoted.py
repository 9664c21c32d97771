"""CSV with line breaks in cells, shared among tasks, against the reader that keeps a file whole."""

import random

import pytest

from holdfast import contract as K
from holdfast.sources import quoted, readers


@pytest.fixture
def small_blocks(spark):
    """Blocks of some hundred bytes, so that small files have many of them."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "300")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    yield
    for key in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
        spark.conf.unset(f"spark.sql.files.{key}")


def cell(rng):
    kind = rng.randrange(6)
    if kind == 0:
        return '"' + "".join(rng.choice(['a', ' ', '\n', '""', ',', 'é']) for _ in range(rng.randrange(1, 200))) + '"'
    if kind == 1:
        return '"\n\n"'
    if kind == 2:
        return ""
    return "".join(rng.choice("abcé 1") for _ in range(rng.randrange(1, 30)))


def feed(folder, rng, files, rows, end="\n"):
    folder.mkdir()
    for f in range(files):
        text = 'key,first,"two\nlines",last' + end
        for k in range(rows):
            text += ",".join([f"{f}-{k}", cell(rng), cell(rng), cell(rng)]) + end
        (folder / f"part {f}.csv").write_text(text, newline="")
    return str(folder)


def whole(spark, path):
    return (spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True)
            .option("nullValue", "\u0000").csv(path).na.fill(""))


def test_equals_the_reader_that_keeps_a_file_whole(spark, tmp_path, small_blocks):
    for k in range(3):
        path = feed(tmp_path / f"feed{k}", random.Random(k), 1 + k, 120)
        got = readers.read_text_csv(spark, path, multi_line=True)
        want = whole(spark, path)
        assert got.columns == want.columns == ["key", "first", "two\nlines", "last"]
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_a_file_is_read_by_many_tasks(spark, tmp_path, small_blocks):
    path = feed(tmp_path / "feed", random.Random(9), 1, 200)
    text = quoted.lines(spark, [f"{path}/part 0.csv"])
    assert text.rdd.getNumPartitions() >= 10
    found = quoted.records(spark, [f"{path}/part 0.csv"])
    assert found.count() == 200
    assert found.select("at").distinct().count() >= 10
    order = [r.record.split(",")[0] for r in found.orderBy("at", "row").collect()]
    assert order == [f"0-{k}" for k in range(200)]


def test_order_survives_a_shuffled_join(spark, tmp_path, small_blocks, monkeypatch):
    path = feed(tmp_path / "feed", random.Random(12), 2, 60)
    want = sorted(map(tuple, readers.read_text_csv(spark, path, multi_line=True).collect()))
    monkeypatch.setattr(quoted, "fits_broadcast", lambda df: False)
    assert sorted(map(tuple, readers.read_text_csv(spark, path, multi_line=True).collect())) == want


def test_windows_line_ends_blank_lines_and_marks(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes(b'\xef\xbb\xbfa,b\r\n1,"x\r\ny"\r\n\r\n  \r\n2,\r\n')
    rows = readers.read_text_csv(spark, str(path), multi_line=True).collect()
    assert [tuple(r) for r in rows] == [("1", "x\ny"), ("2", "")]


def test_broken_files_fail(spark, tmp_path):
    for name, text in (("open", 'a,b\n1,"x\n2,y\n'), ("cells", 'a,b\n1,"x\ny",3\n')):
        path = tmp_path / f"{name}.csv"
        path.write_text(text)
        with pytest.raises(Exception, match="ends inside a quoted cell|MALFORMED"):
            readers.read_text_csv(spark, str(path), multi_line=True).collect()


def test_nothing_but_a_header_and_nothing_at_all(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "head.csv").write_text('a,"b\nc"')
    (tmp_path / "in" / "empty.csv").write_text("")
    assert readers.read_text_csv(spark, str(tmp_path / "in"), multi_line=True).count() == 0
    assert list(readers.headers(spark, str(tmp_path / "in"))) == [("a", "b\nc")]


def test_heads_take_no_job_and_few_bytes(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(3):
        (tmp_path / "in" / f"f{k} x.csv").write_text(",".join(K.RAW_COLUMNS) + "\n" + "x\n" * 50_000)
    (tmp_path / "in" / "wide.csv").write_text(",".join(f"c{k}" for k in range(9000)) + "\nx\n")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("heads", "heads")
    found = readers.headers(spark, str(tmp_path / "in"))
    jobs = tracker.getJobIdsForGroup("heads")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 0
    assert sorted(map(len, found.values())) == [1, 3] and len(found[tuple(K.RAW_COLUMNS)]) == 3


def test_customers_with_line_breaks_keep_the_feed_order(spark, tmp_path, small_blocks):
    row = ",".join(f'"{c}\n!"' for c in K.RAW_COLUMNS[1:])
    text = ",".join(K.RAW_COLUMNS) + "\n" + "".join(f"{k:03d},{row}\n" for k in range(40))
    (tmp_path / "c.csv").write_text(text)
    df = readers.read_customers(spark, str(tmp_path / "c.csv"), multi_line=True)
    assert [r.customerID for r in df.orderBy("feed_seq").collect()] == [f"{k:03d}" for k in range(40)]
