"""Merge-on-read tables, version logs, leases of period runs and batches that fail."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from arborpay.sources.merge_table import MergeTable
from arborpay.sources.versions import LeaseError, PeriodRuns, VersionedTable
from arborpay.streaming import ingest as ingest_module
from arborpay.streaming.ingest import Ingest

CHANGE = "id string, op string, event_ts timestamp, partition int, offset long, v int"


def change(spark, *rows, extra=""):
    """(id, op, minute, offset, v, ...) as change rows."""
    df = spark.createDataFrame([(i, op, m, 0, o, *rest) for i, op, m, o, *rest in rows], "id string, op string, m int, partition int, offset long, v int" + extra)
    return df.withColumn("event_ts", F.timestamp_seconds(F.col("m") * 60)).drop("m")


def live(table, **where):
    return sorted(tuple(r) for r in table.read(["id", "v"], **where)[0].collect())


def size(path):
    return sum(p.stat().st_size for p in Path(path).rglob("*.parquet"))


def test_reads_merge_what_came_in_any_order(spark, tmp_path):
    table = MergeTable(spark, f"file://{tmp_path}/t", buckets=4)
    assert table.version() == 0
    with pytest.raises(AnalysisException):
        table.read()
    table.merge(change(spark, ("a", "u", 5, 5, 50), ("b", "c", 1, 1, 10), ("d", "d", 9, 9, None)))
    table.merge(change(spark, ("a", "u", 2, 2, 20), ("c", "c", 3, 3, 30), ("d", "c", 8, 8, 80)))  # late for a and d
    assert live(table) == [("a", 50), ("b", 10), ("c", 30)]
    before = table.compact()
    assert live(table) == [("a", 50), ("b", 10), ("c", 30)]
    table.merge(change(spark, ("d", "u", 8, 8, 81)))  # the base remembers the delete
    last = table.merge(change(spark, ("b", "d", 7, 7, None), ("a", "u", 5, 6, 51)))  # of one time, the later offset
    assert live(table) == [("a", 51), ("c", 30)]
    assert table.merge(change(spark, ("b", "d", 7, 7, None))) > last and live(table) == [("a", 51), ("c", 30)]  # twice
    assert live(table, version=before) == [("a", 50), ("b", 10), ("c", 30)] and live(table, version=1) == [("a", 50), ("b", 10)]
    assert [tuple(r) for r in table.row("a").select("id", "v").collect()] == [("a", 51)]
    plan = table.row("a")._jdf.queryExecution().toString()
    assert "bucket" in plan.split("PartitionFilters")[1].split("]")[0]  # the other buckets aren't read


def test_a_delta_that_comes_while_a_base_is_written_counts(spark, tmp_path):
    table = MergeTable(spark, f"file://{tmp_path}/t")
    table.merge(change(spark, ("a", "c", 1, 1, 1)))
    through = table.version()
    rows = table.whole(through).drop("bucket")
    table.merge(change(spark, ("b", "c", 2, 2, 2)))
    table._commit(rows, "base", through)  # its number is higher than that of the delta it doesn't hold
    assert live(table) == [("a", 1), ("b", 2)]


def test_a_small_batch_writes_little(spark, tmp_path):
    table = MergeTable(spark, f"file://{tmp_path}/t", buckets=4)
    rows = spark.range(20_000).select(F.col("id").cast("string").alias("id"), F.lit("c").alias("op"), F.timestamp_seconds("id").alias("event_ts"), F.lit(0).alias("partition"), F.col("id").alias("offset"), F.sha2(F.col("id").cast("string"), 512).alias("v"))
    table.merge(rows)
    whole = size(tmp_path)
    table.merge(rows.where("offset % 100 = 0").withColumns({"offset": F.col("offset") + 100_000, "v": F.upper("v")}).withColumn("event_ts", F.col("event_ts") + F.expr("interval 1 day")))
    assert size(tmp_path) - whole < 0.05 * whole
    assert table.read()[0].where("v = upper(v)").count() == 200


def test_columns_that_come_later_are_nulls_before(spark, tmp_path):
    table = MergeTable(spark, f"file://{tmp_path}/t")
    table.merge(change(spark, ("a", "c", 1, 1, 1)))
    table.merge(change(spark, ("b", "c", 2, 2, 2, "new"), extra=", w string"))
    assert sorted(map(tuple, table.read(["id", "w"])[0].collect())) == [("a", None), ("b", "new")]


def test_vacuum_spares_what_is_kept(spark, tmp_path):
    table = MergeTable(spark, f"file://{tmp_path}/t")
    for k in range(4):
        table.merge(change(spark, (str(k), "c", k, k, k)))
        if k == 1:
            table.keep(table.version())
    table.compact()
    now = time.time_ns() // 1_000_000
    gone = table.vacuum(now)
    assert gone == [3, 4] and len(live(table)) == 4 and len(live(table, version=2)) == 2
    table.merge(change(spark, ("9", "c", 9, 9, 9)))
    assert table.vacuum(now) == [] and len(live(table)) == 5 and table.version_at(now) == 5


def test_many_deltas_are_compacted(spark, tmp_path):
    table = MergeTable(spark, f"file://{tmp_path}/t", buckets=1)
    for k in range(10):
        table.merge(change(spark, (str(k), "c", k, k, k)))
        table.maintain()
    assert [c.kind for c in table.commits()].count("base") == 1 and len(live(table)) == 10


def test_a_withdrawn_version_does_not_come_back(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/t")
    rows = lambda n: spark.range(n).withColumnRenamed("id", "k")
    table.publish(rows(1), "k")
    table.publish(rows(2), "k")
    early = time.time_ns() // 1_000_000
    assert table.roll_back() == 1
    time.sleep(0.05)
    table.publish(rows(3).withColumn("w", F.lit("x")), "k")
    assert table.read()[0].count() == 3 and table.roll_back() == 1 and table.read()[0].count() == 1
    with pytest.raises(AnalysisException):
        table.roll_back()
    assert table.version_at(early) == 2 and table.version_at(0) == 0
    table.publish(rows(3).withColumn("w", F.lit("x")), "k")
    assert [tuple(r) for r in table.read(version=1, newest=True)[0].collect()] == [(0, None)]


def test_a_lost_driver_is_taken_over(spark, tmp_path):
    first, second = (PeriodRuns(spark, f"file://{tmp_path}", lease=1.5) for _ in range(2))
    run = first.begin(1, first=True)
    first.beat(1, run, "month")
    assert first.status(1) == "RUNNING"
    with pytest.raises(LeaseError):
        second.begin(1, first=True)
    with pytest.raises(LeaseError):
        second.guard(1)  # no orders while it is settled
    time.sleep(2.2)
    assert second.status(1) == "LOST"
    later = second.begin(1, first=True)
    for late in (lambda: first.beat(1, run), lambda: first.end(1, run, {"x": spark.range(9)})):
        with pytest.raises(LeaseError):
            late()
    second.end(1, later, {"x": spark.range(3)})
    assert second.read(1, "x").count() == 3 and second.status(1) == "DONE"
    assert second.steps(1) == [("RUNNING", "prepared"), ("RUNNING", "month"), ("RUNNING", "prepared"), ("RUNNING", "written"), ("DONE", "")]
    with pytest.raises(LeaseError):
        second.end(1, later, None)  # ended already


def test_of_two_drivers_one_begins(spark, tmp_path, monkeypatch):
    a, b = (PeriodRuns(spark, f"file://{tmp_path}") for _ in range(2))
    seen = b._fences(1)
    a.begin(1, first=True)
    monkeypatch.setattr(b, "_fences", lambda period: seen)  # both looked before either wrote
    monkeypatch.setattr(b, "status", lambda period: "OPEN")
    with pytest.raises(LeaseError):
        b.begin(1, first=True)


def messages(spark, n, topic="orders"):
    return spark.range(n).select(F.lit(topic).alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"), F.current_timestamp().alias("timestamp"), F.lit(None).cast("string").alias("key"), F.col("id").cast("string").alias("value"))


def test_a_poisonous_message_stands_alone_in_the_end(spark, tmp_path):
    arrived = set()

    def processor(rows, batch):
        values = [r["value"] for r in rows.collect()]
        if "13" in values or "29" in values:
            raise ValueError("can't take 13 or 29")
        arrived.update(values)

    good = []
    topics = {"orders": "id string", "other": "id string"}
    ingest = lambda: Ingest(spark, f"file://{tmp_path}", topics, {"orders": processor, "other": lambda rows, batch: good.append(rows.count())})
    rows = messages(spark, 40).unionByName(messages(spark, 3, "other"))
    for k in range(ingest_module.ATTEMPTS - 1):
        with pytest.raises(ValueError):
            ingest().batch(rows, 7)  # a new driver each time
        assert ingest().attempts("orders", 7) == k + 1
    assert good == [3] and not arrived
    ingest().batch(rows, 7)
    assert arrived == {str(i) for i in range(40)} - {"13", "29"} and good == [3]
    dead = ingest().dead("orders").collect()
    assert {r["value"] for r in dead} == {"13", "29"} and all("can't take" in r["error"] for r in dead)
    ingest().batch(rows, 7)
    assert good == [3]  # applied


def test_a_batch_that_recovers_is_not_searched(spark, tmp_path):
    calls = []

    def processor(rows, batch):
        calls.append(rows.count())
        if len(calls) < 3:
            raise RuntimeError("not now")

    ingest = Ingest(spark, f"file://{tmp_path}", {"orders": "id string"}, {"orders": processor})
    for _ in range(2):
        with pytest.raises(RuntimeError):
            ingest.batch(messages(spark, 5), 1)
    ingest.batch(messages(spark, 5), 1)
    assert calls == [5, 5, 5] and not (tmp_path / "dead").exists()
