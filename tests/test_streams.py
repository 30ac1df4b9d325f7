"""Change streams, versioned tables and incremental state."""

import datetime
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from arborpay.operators import elite, tree, volume
from arborpay.sources.merge_table import MergeTable
from arborpay.sources.versions import GateError, PeriodRuns, VersionedTable, back_up, of_period
from arborpay.streaming import changes, incremental
from arborpay.streaming.ingest import MESSAGES, USER, Ingest, files

SPONSOR = [(1, 3), (2, 3), (3, 4), (4, 5), (5, -1), (9, 1), (10, 2)]
MORE = [*SPONSOR, (13, 1), (8, -1), (7, 8)]


def message(offset, user, parent, op="u", ts=1000, topic="user"):
    row = {"id": user, "user": user, "parent": parent, "placementId": None, "placementLeg": None, "updatetime": 1}
    value = None if op == "t" else json.dumps({"before": row if op == "d" else None, "after": None if op == "d" else row, "op": op, "ts_ms": ts})
    return (topic, 0, offset, None, json.dumps({"id": user}), value)


def test_stream_to_table(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    ingest = Ingest(spark, f"file://{out}", {"user": USER})

    def arrive(name, rows):
        keys = [f.split()[0] for f in MESSAGES.split(", ")]
        (source / name).write_text("\n".join(json.dumps(dict(zip(keys, r, strict=True))) for r in rows))
        ingest.start(files(spark, f"file://{source}")).awaitTermination()

    arrive("a.json", [message(0, "3", "4", "c", 1000), message(1, "3", "8", "u", 2000), message(2, "5", "0", "c", 1000), ("user", 0, 3, None, None, "not json")])
    rows, version = ingest.table("user").read(["id", "parent"])
    assert version == 1 and {tuple(r) for r in rows.collect()} == {("3", "8"), ("5", "0")}
    assert spark.read.parquet(f"file://{out}/dead").count() == 1
    arrive("b.json", [message(4, "3", "9", "u", 1500), message(5, "5", "0", "d", 3000)])  # late, then a delete
    rows, version = ingest.table("user").read(["id", "parent"])
    assert version == 2 and {tuple(r) for r in rows.collect()} == {("3", "8")}


def test_publish_gate_and_roll_back(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/t")
    assert table.publish(spark.createDataFrame([(1, "a")], "id long, x string"), "id") == 1
    assert table.publish(spark.createDataFrame([(1, "b"), (2, "c")], "id long, x string"), "id") == 2
    for bad in ([(1, "a"), (1, "b")], []):
        with pytest.raises(GateError):
            table.publish(spark.createDataFrame(bad, "id long, x string"), "id")
    assert table.read()[0].count() == 2
    assert table.roll_back() == 1 and table.read()[0].first()["x"] == "a"


def test_backup_by_period(spark, tmp_path):
    back_up({"r": spark.range(3).toDF("id")}, f"file://{tmp_path}", 7)
    assert of_period(spark, f"file://{tmp_path}", "r", 7).count() == 3


def test_diff(spark):
    old, new = (spark.createDataFrame(r, "user_id long, rank int") for r in ([(1, 10), (2, 20), (3, 10)], [(1, 20), (2, 10), (3, 10), (4, 30)]))
    got = {(r["user_id"], r["direction"]) for r in changes.diff(old, new, "user_id", "rank").collect()}
    assert got == {(1, "UP"), (2, "DOWN"), (4, "UP")}
    assert {r["user_id"] for r in changes.diff(old, new, "user_id", "rank", only_up=True).collect()} == {1, 4}


def test_incremental_ranks_equal_recomputation(spark, ws):
    sponsor = spark.createDataFrame(SPONSOR, "user_id long, parent_id long")

    def snapshot(pv):
        own = spark.createDataFrame([(u, p) for u, p in pv.items()], "user_id long, pv_own long")
        return elite.rank_snapshot(ws, sponsor, own)

    state = snapshot({9: 90_000, 1: 60_000, 10: 200_000})
    orders = spark.createDataFrame([(1, 9, 20_000), (2, 10, -150_000), (2, 10, -150_000), (3, 4, -5)], "order_id long, user_id long, pv long")
    applied = spark.createDataFrame([(99,)], "order_id long")
    got = incremental.apply_ranks(ws, state, sponsor, incremental.new_orders(orders, applied))
    expected = snapshot({9: 110_000, 1: 60_000, 10: 50_000})
    columns = ["user_id", "pv_own", "gpv", "legs", "contrib", "virtual_width", "is_elite", "rank"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, expected.select(columns).collect()))


def test_incremental_legs_equal_recomputation(spark, ws):
    placement = spark.createDataFrame([(100, -1, 0)] + [(2 * i - 99 + k, i, k + 1) for i in range(100, 107) for k in (0, 1)], "user_id long, parent_id long, leg int")

    def legs(pv):
        return volume.leg_volume(ws, placement, spark.createDataFrame(list(pv.items()), "user_id long, pv_own long"))

    more = spark.createDataFrame([(108, 500), (114, 70), (100, 9)], "user_id long, pv long")
    got = incremental.apply_leg_volume(ws, legs({107: 1000, 114: 30}), placement, more)
    expected = legs({107: 1000, 114: 100, 108: 500, 100: 9})
    columns = ["user_id", "pv_1l", "pv_2l"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, expected.select(columns).collect()))


def test_topology_move(spark, ws):
    sponsor = incremental.move_member(spark.createDataFrame([(1, 3), (3, 4), (4, -1), (8, -1)], "user_id long, parent_id long"), 3, 8)
    own = spark.createDataFrame([(3, 50_000)], "user_id long, pv_own long")
    got = {r["user_id"]: r["gpv"] for r in elite.rank_snapshot(ws, sponsor, own).collect()}
    assert got == {1: 0, 3: 50_000, 4: 0, 8: 50_000}


def test_period_runs(spark, tmp_path):
    runs = PeriodRuns(spark, f"file://{tmp_path}")
    rows = spark.range(3)
    first = runs.begin(1, first=True)
    assert not runs.writable(1) and PeriodRuns(spark, f"file://{tmp_path}").status(1) == "RUNNING"  # another driver sees it
    with pytest.raises(ValueError):
        runs.begin(2)
    with pytest.raises(AnalysisException):
        runs.read(1, "total")
    runs.end(1, first, {"total": rows, "rank": rows})
    assert runs.read(1, "total").count() == 3
    second = runs.begin(2)
    with pytest.raises(ValueError):
        runs.begin(2)
    with pytest.raises(Exception):
        runs.end(2, second, {"total": rows, "rank": rows.select(F.raise_error(F.lit("stopped")).alias("x"))})
    assert runs.status(2) == "FAILED"
    with pytest.raises(AnalysisException):
        runs.read(2, "total")  # nothing of a failed run is published
    again = runs.begin(2)
    runs.end(2, again, {"total": rows.limit(1), "rank": rows})
    assert runs.read(2, "total").count() == 1 and runs.read(1, "total").count() == 3


def test_incremental_bonus_equals_recomputation(spark, ws):
    sponsor = spark.createDataFrame(MORE, "user_id long, parent_id long")

    def net(pv):
        team = volume.team_volume(ws, tree.depths(ws, sponsor), spark.createDataFrame(list(pv.items()), "user_id long, pv_own long"))
        return elite.elite_net(ws, team)

    columns = ["user_id", "pv_own", "gpv", "elite", "gpv_real"]
    rows = lambda df: sorted(map(tuple, df.select(columns).collect()))
    state = net({9: 80_000, 1: 20_000, 10: 200_000})
    assert {r["user_id"]: r["bonus_e"] for r in elite.elite_bonus(state, 150_000).collect()}[1] == 15_000
    # A refund takes 1's qualification away, an order gives one to 13; a refund beyond what there is is ignored.
    orders = spark.createDataFrame([(1, 1, -5_000), (2, 13, 150_000), (3, 10, -150_000), (4, 9, -90_000)], "order_id long, user_id long, pv long")
    got = ws.table(incremental.apply_bonus(ws, state, sponsor, orders), "bonus-state")
    assert rows(got) == rows(net({9: 80_000, 1: 15_000, 10: 50_000, 13: 150_000}))
    back = spark.createDataFrame([(5, 13, -150_000), (6, 1, 5_000), (7, 10, 150_000)], "order_id long, user_id long, pv long")
    assert rows(incremental.apply_bonus(ws, got, sponsor, back)) == rows(net({9: 80_000, 1: 20_000, 10: 200_000, 13: 0}))


def test_moves_equal_recomputation_and_bad_ones_are_refused(spark, ws):
    sponsor = spark.createDataFrame(MORE, "user_id long, parent_id long")
    own = spark.createDataFrame([(9, 90_000), (13, 120_000), (10, 200_000), (7, 50_000)], "user_id long, pv_own long")
    old = tree.depths(ws, sponsor)
    moves = spark.createDataFrame([(1, 8), (14, 10)], "user_id long, parent_id long")
    new = ws.table(incremental.patch(ws, old, moves), "new-tree")
    got = incremental.apply_moves(ws, elite.rank_snapshot(ws, sponsor, own), old, new, moves)
    columns = ["user_id", "parent_id", "depth", "pv_own", "gpv", "legs", "contrib", "rank"]
    rows = lambda df: sorted(map(tuple, df.select(columns).collect()))
    assert rows(got) == rows(elite.rank_snapshot(ws, new.select("user_id", "parent_id"), own))
    for bad in ([(4, 1)], [(2, 77)]):  # a cycle; no such parent
        with pytest.raises(tree.TreeError):
            incremental.patch(ws, old, spark.createDataFrame(bad, "user_id long, parent_id long"))
    placement = spark.createDataFrame([(1, -1, 0), (2, 1, 1), (3, 1, 2)], "user_id long, parent_id long, leg int")
    for bad in ([(4, 1, 2)], [(4, 2, 3)]):  # a leg taken; no such leg
        with pytest.raises(tree.TreeError):
            incremental.patch(ws, placement, spark.createDataFrame(bad, "user_id long, parent_id long, leg int"))
    assert incremental.patch(ws, placement, spark.createDataFrame([(4, 2, 1)], "user_id long, parent_id long, leg int")).count() == 4


def test_a_stopped_writer_loses_nothing(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, f"file://{tmp_path}/t")
    schema = "id string, event_ts timestamp, v int, op string, partition int, offset long"
    at = lambda s: datetime.datetime(2026, 1, 1, 0, 0, s)
    table.merge(spark.createDataFrame([(str(i), at(1), i, "c", 0, i) for i in range(5)], schema))
    monkeypatch.setattr(table, "_point", lambda version: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError):
        table.merge(spark.createDataFrame([("9", at(2), 9, "c", 0, 9)], schema))
    monkeypatch.undo()
    assert table.version() == 1 and table.read()[0].count() == 5
    table.merge(spark.createDataFrame([("9", at(2), 9, "c", 0, 9)], schema))
    assert table.version() == 2 and table.read()[0].count() == 6
    assert table.roll_back() == 1 and table.read()[0].count() == 5
    assert table.merge(spark.createDataFrame([("8", at(3), 8, "c", 0, 8)], schema)) == 3  # never a version that was published


def test_an_older_change_does_not_revive_a_deleted_row(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/t")
    schema = "id string, event_ts timestamp, v int, op string, partition int, offset long"
    at = lambda s: datetime.datetime(2026, 1, 1, 0, 0, s)
    for row in (("1", at(10), 1, "c"), ("2", at(10), 2, "c"), ("1", at(30), None, "d"), ("1", at(20), 5, "u")):
        table.merge(spark.createDataFrame([(*row, 0, 1)], schema))
    assert [r["id"] for r in table.read()[0].collect()] == ["2"]
    table.merge(spark.createDataFrame([("1", at(40), 7, "u", 0, 1)], schema))
    assert sorted((r["id"], r["v"]) for r in table.read()[0].collect()) == [("1", 7), ("2", 2)]
    late = datetime.datetime(2026, 6, 1)
    table.merge(spark.createDataFrame([("2", at(50), None, "d", 0, 1)], schema))
    table.merge(spark.createDataFrame([("3", late, 1, "c", 0, 1)], schema))
    assert table.whole(table.version()).where("gone").count() == 0  # remembered for a bounded time


def test_a_failed_batch_is_replayed(spark, tmp_path, monkeypatch):
    ingest = Ingest(spark, f"file://{tmp_path}/o", {"user": USER, "other": USER})
    sent = [(t, 0, 1, None, json.dumps({"id": "1"}), json.dumps({"before": None, "after": {"id": "1", "user": "u"}, "op": "c", "ts_ms": 5})) for t in ("user", "other")]
    messages = spark.createDataFrame(sent, MESSAGES)
    merge = MergeTable.merge
    monkeypatch.setattr(MergeTable, "merge", lambda self, rows: (_ for _ in ()).throw(OSError("away")) if self.path.endswith("user") else merge(self, rows))
    with pytest.raises(OSError):
        ingest.batch(messages, 0)
    assert ingest.table("other").read()[0].count() == 1 and not (tmp_path / "o" / "dead").exists()
    monkeypatch.undo()
    ingest.batch(messages, 0)
    assert ingest.table("user").read()[0].count() == 1 and ingest.table("other").version() == 1


def test_newest_wins(spark):
    rows = spark.createDataFrame([(1, 5, 0, 1, "a"), (1, 5, 0, 2, "b"), (1, 4, 0, 9, "c")], "id int, event_ts int, partition int, offset int, v string")
    assert changes.newest(rows, "id").first()["v"] == "b"
    assert changes.notices(rows.select(F.col("v")), 3).first()["key"] == "3"


def test_refunds_are_decided_one_by_one(spark, ws):
    """+30, then -50: only the second is ignored, however the events are dealt to batches; both states take the same orders."""
    sponsor = spark.createDataFrame(SPONSOR, "user_id long, parent_id long")
    placement = spark.createDataFrame([(1, -1, 0), (9, 1, 1), (10, 1, 2)], "user_id long, parent_id long, leg int")
    own = lambda pv: spark.createDataFrame(list(pv.items()), "user_id long, pv_own long")
    schema = "order_id long, user_id long, pv long, event_ts long"
    # The order ids don't follow event time; 77 is no member.
    events = [(8, 9, 30, 1), (2, 9, -50, 2), (3, 9, 40, 3), (1, 9, -60, 4), (5, 10, 20, 1), (5, 10, 20, 9), (6, 77, 5, 1)]

    def run(batches):
        ranks, legs, applied = elite.rank_snapshot(ws, sponsor, own({9: 0})), volume.leg_volume(ws, placement, own({9: 0})), spark.createDataFrame([], "order_id long")
        rejected = set()
        for batch in batches:
            got = incremental.apply_batch(ws, ranks, legs, sponsor, placement, spark.createDataFrame(batch, schema), applied)
            ranks, legs, applied = (ws.table(t, "batch") for t in got[:3])
            rejected |= {r["order_id"] for r in got.rejected.collect()}
        return sorted(map(tuple, ranks.select("user_id", "pv_own", "gpv").collect())), sorted(map(tuple, legs.collect())), sorted(r[0] for r in applied.collect()), rejected

    whole = run([events])
    assert {u: p for u, p, _ in whole[0] if p} == {9: 10, 10: 20}
    assert (1, 10, 20) in whole[1]
    assert whole[2] == [1, 3, 5, 8] and whole[3] == {2, 6}
    assert run([events[:1], events[1:3], events[3:]]) == whole
    # Ranks alone decide in the same way.
    first = spark.createDataFrame(events[:2], schema)
    got = incremental.apply_ranks(ws, elite.rank_snapshot(ws, sponsor, own({9: 0})), sponsor, first)
    assert got.where("user_id = 9").first()["pv_own"] == 30


def test_bad_legs_are_marked(spark):
    def sent(i, placement, leg, op="u"):
        row = {"id": str(i), "placementId": placement, "placementLeg": leg}
        return ("user", 0, i, None, json.dumps({"id": str(i)}), json.dumps({"before": row if op == "d" else None, "after": None if op == "d" else row, "op": op, "ts_ms": 1}))

    rows = [sent(1, "7", 1), sent(2, "7", 3), sent(3, "7", None), sent(4, "0", 0), sent(5, None, None), sent(6, "7", 2, "c"), sent(7, "7", 0, "d"), ("user", 0, 8, None, json.dumps({"id": "8"}), None)]
    got = changes.parse(spark.createDataFrame(rows, MESSAGES), USER)
    assert {r["id"] for r in got.where("bad").collect()} == {"2", "3"}
    assert changes.newest(got.where("not bad"), "id").count() == 6
