"""Polls: tables published together, only touched periods read and written, refusals, repeats, restarts."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from panelmill.streaming import polls

TABLES = {
    "facts": polls.Table("entity bigint, month string, revenue bigint", "month"),
    "seen": polls.Table("entity bigint, month string, n bigint", "month"),
}
SCHEMA = "entity bigint, month string, revenue bigint"


def apply(batch, current):
    keys = ["entity", "month"]
    facts = current("facts").join(batch, keys, "left_anti").unionByName(batch)
    counts = current("seen").unionByName(batch.select(*keys, F.lit(1).cast("long").alias("n")))
    return {"facts": facts, "seen": counts.groupBy(*keys).agg(F.sum("n").alias("n"))}


def refuse_negative(written):
    if written["facts"].where("revenue < 0").head(1):
        raise polls.Refused("negative revenue")


@pytest.fixture
def job(spark, tmp_path):
    target = polls.Published(spark, str(tmp_path / "tables"), TABLES)

    def poll(*records, gate=None):
        spark.createDataFrame(records, SCHEMA).write.mode("append").parquet(str(tmp_path / "arrived"))
        stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "arrived"))
        polls.apply_polls(stream, target, F.col("month"), apply, str(tmp_path / "checkpoint"), gate, refuse_negative)
        return target

    return poll


def test_polls_change_all_tables_of_the_touched_months(job):
    job((1, "2024-01", 10), (2, "2024-02", 20))
    before = job((3, "2024-02", 5)).state()
    target = job((1, "2024-01", 11), (4, "2024-03", 7))
    assert rows(target.read("facts")) == [(1, "2024-01", 11), (2, "2024-02", 20), (3, "2024-02", 5), (4, "2024-03", 7)]
    assert rows(target.read("seen")) == [(1, "2024-01", 2), (2, "2024-02", 1), (3, "2024-02", 1), (4, "2024-03", 1)]
    after = target.state()
    for table in TABLES:
        assert after["tables"][table]["2024-02"] == before["tables"][table]["2024-02"]
        assert after["tables"][table]["2024-01"] != before["tables"][table]["2024-01"]
    files = target.read("facts", ["2024-02"]).inputFiles()
    assert files and all("_part=2024-02" in f for f in files)
    assert rows(target.log().select("batch", "decision")) == [(0, "published"), (1, "published"), (2, "published")]


def test_refused_polls_leave_nothing_behind(job, tmp_path):
    def down(batch):
        if batch.where("entity = 9").head(1):
            raise polls.Refused("deferred")

    job((1, "2024-01", 10))
    target = job((2, "2024-01", -5), (2, "2024-02", 5))
    assert rows(target.read("facts")) == [(1, "2024-01", 10)] and rows(target.read("seen")) == [(1, "2024-01", 1)]
    assert not list((tmp_path / "tables" / "data").glob("batch=1-*"))
    job((9, "2024-01", 1), gate=down)
    target = job((2, "2024-02", 6), gate=down)
    assert rows(target.read("facts")) == [(1, "2024-01", 10), (2, "2024-02", 6)]
    assert rows(target.log().select("batch", "decision", "reason")) == [
        (0, "published", None), (1, "refused", "negative revenue"), (2, "refused", "deferred"), (3, "published", None),
    ]


def test_a_batch_that_comes_again_does_nothing(spark, job):
    target = job((1, "2024-01", 10))
    state = target.state()
    again = spark.createDataFrame([(1, "2024-01", 99)], SCHEMA)
    assert target.publish(0, ["2024-01"], {"facts": again}) == "repeated"
    assert target.state() == state
    other = polls.Published(spark, target.folder, TABLES)
    assert other.has(0) and rows(other.read("facts")) == [(1, "2024-01", 10)]
    with pytest.raises(FileExistsError):
        target._save(0, state)


def test_rows_without_month_and_emptied_months(spark, tmp_path):
    target = polls.Published(spark, str(tmp_path / "t"), TABLES)
    assert target.read("facts").collect() == []
    frame = spark.createDataFrame([(1, None, 5), (2, "2024-01", 6)], SCHEMA)
    assert target.publish(0, ["none", "2024-01"], {"facts": frame}) == "published"
    assert rows(target.read("facts", ["none"])) == [(1, None, 5)]
    assert target.publish(1, ["2024-01"], {"facts": frame.limit(0)}) == "published"
    assert rows(target.read("facts")) == [(1, None, 5)]
    with pytest.raises(ValueError, match="not touched"):
        target.publish(2, ["2024-01"], {"facts": frame})


def test_a_table_that_a_poll_leaves_alone_stays(spark, tmp_path):
    target = polls.Published(spark, str(tmp_path / "t"), TABLES)
    target.publish(0, ["2024-01"], {"seen": spark.createDataFrame([(1, "2024-01", 3)], TABLES["seen"].schema)})
    target.publish(1, ["2024-01"], {"facts": spark.createDataFrame([(1, "2024-01", 6)], SCHEMA)})
    assert rows(target.read("seen")) == [(1, "2024-01", 3)] and rows(target.read("facts")) == [(1, "2024-01", 6)]
