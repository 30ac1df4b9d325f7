"""Order events as a stream with state, and the outbox of its changes."""

import json

import pytest
from pyspark.sql import functions as F

from arborpay.operators import elite, volume
from arborpay.sources.versions import PeriodRuns
from arborpay.streaming.order_stream import ORDERS, OrderStream, into, net_changes

SPONSOR = [(1, -1), *((k, k // 3 + 1) for k in range(2, 14))]
PLACEMENT = [(1, -1, 0), *((k, k // 2, k % 2 + 1) for k in range(2, 14))]
#: In event order: rises over a limit, a refund that takes it back, one that is too big, a repeat, one that comes again after more volume, a stranger.
EVENTS = [(k, 7, 1 + k % 13, 40_000 + 9_000 * k, k) for k in range(1, 15)]
EVENTS += [(20, 7, 5, -EVENTS[3][3], 20), (21, 7, 6, -900_000, 21), (3, 7, 4, 67_000, 22), (22, 7, 6, 950_000, 23), (21, 7, 6, -900_000, 24), (23, 7, 77, 5, 25), (24, 8, 2, 300, 26)]


@pytest.fixture(scope="module")
def trees(spark, ws):
    return ws.table(spark.createDataFrame(SPONSOR, "user_id long, parent_id long")), ws.table(spark.createDataFrame(PLACEMENT, "user_id long, parent_id long, leg int"))


def state(stream, period=7):
    ranks = sorted(map(tuple, stream.ranks(period).select("user_id", "pv_own", "gpv", "rank", "legs", "contrib").collect()))
    legs = sorted(map(tuple, stream.legs(period).collect()))
    return ranks, legs, sorted(map(tuple, stream.decided(period).collect()))


def test_dealt_to_batches_as_one(spark, ws, trees, tmp_path):
    """Seven files as seven micro-batches, one of them replayed, leave what one batch leaves, and that is the full recomputation."""
    one = OrderStream(spark, f"{tmp_path}/one", *trees)
    one.batch(spark.createDataFrame(EVENTS, ORDERS), 0)
    got = state(one)
    accepted = {o for o, good in got[2] if good}
    assert {21, 23} == {o for o, _ in got[2]} - accepted  # what was rejected stays so when it is sent again
    seen, own = set(), {}
    for order, period, user, pv, _ in EVENTS:
        if period == 7 and order in accepted and order not in seen:
            seen.add(order)
            own[user] = own.get(user, 0) + pv
    whole = spark.createDataFrame(list(own.items()), "user_id long, pv_own long")
    want = elite.rank_snapshot(ws, trees[0], whole).select("user_id", "pv_own", "gpv", "rank", "legs", "contrib")
    assert got[0] == sorted(map(tuple, want.collect())) and {r[3] for r in got[0]} > {0}
    legs = {r["user_id"]: (r["pv_1l"], r["pv_2l"]) for r in volume.leg_volume(ws, trees[1], whole).collect()}
    assert {u: (a, b) for u, a, b in got[1] if a or b} == {u: v for u, v in legs.items() if v != (0, 0)}

    seven = OrderStream(spark, f"{tmp_path}/seven", *trees)
    names = [c.split()[0] for c in ORDERS.split(", ")]
    (tmp_path / "in").mkdir()
    for k in range(7):
        (tmp_path / "in" / f"{k}.json").write_text("\n".join(json.dumps(dict(zip(names, e, strict=True))) for e in EVENTS[k * 3 : k * 3 + 3]))
        seven.start(spark.readStream.schema(ORDERS).json(f"{tmp_path}/in")).awaitTermination()
    assert [c.source for c in seven.commits()] == [f"b{k}" for k in range(7)]
    seven.batch(spark.createDataFrame(EVENTS[6:9], ORDERS), 2)
    assert len(seven.commits()) == 7 and state(seven) == got and state(seven, 8) == state(one, 8)


def test_outbox(spark, trees, tmp_path, monkeypatch):
    """A stop before a commit shows nothing; one between commit and sending, or after sending, loses and doubles nothing."""
    stream = OrderStream(spark, f"{tmp_path}/s", *trees)
    first, second = (spark.createDataFrame(e, ORDERS) for e in (EVENTS[:10], EVENTS[10:15]))
    with monkeypatch.context() as stopped:
        stopped.setattr(OrderStream, "_commit", lambda *_: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            stream.batch(first, 0)
    assert stream.commits() == [] and stream.deliver("mail", into(f"{tmp_path}/mail")) == 0 and stream.decided(7).isEmpty()
    stream.batch(first, 0)
    keep = into(f"{tmp_path}/mail")

    def stops(events, number):
        keep(events, number)
        raise OSError("stopped")

    with pytest.raises(OSError):
        stream.deliver("mail", stops)
    assert stream.cursor("mail") == 0
    stream.batch(second, 1)
    stream.close(7)
    stream.close(7)
    assert stream.deliver("mail", keep) == 3 and stream.deliver("mail", keep) == 0
    told = spark.read.parquet(f"{tmp_path}/mail")
    assert told.count() == told.select("event_key").distinct().count()
    assert told.where("event_type = 'SETTLEMENT_PERIOD_DONE'").count() == 1
    ranks = {r["user_id"]: r["rank"] for r in stream.ranks(7).collect() if r["rank"]}
    assert {r["user_id"]: r["new_value"] for r in net_changes(told).collect()} == ranks and ranks
    # Another consumer starts from the beginning.
    assert stream.deliver("audit", into(f"{tmp_path}/audit")) == 3
    assert stream.vacuum() == [1]
    assert {r["user_id"]: r["rank"] for r in stream.ranks(7).collect() if r["rank"]} == ranks


def test_closed_periods_refuse(spark, trees, tmp_path):
    """Orders of a closed or running period, without a period or without an id are kept apart; ids are forgotten with the period."""
    runs = PeriodRuns(spark, f"{tmp_path}/runs")
    stream = OrderStream(spark, f"{tmp_path}/s", *trees, runs)
    stream.batch(spark.createDataFrame([(1, 7, 2, 500, 1), (2, 8, 3, 700, 1)], ORDERS), 0)
    stream.close(7)
    runs.begin(8, first=True)
    late = [(3, 7, 2, 500, 2), (4, 8, 3, 500, 2), (5, None, 2, 5, 2), (None, 9, 2, 5, 2), (6, 9, 2, 5, 2)]
    stream.batch(spark.createDataFrame(late, ORDERS), 1)
    assert sorted(map(tuple, stream.refused().select(F.coalesce("order_id", F.lit(0))).collect())) == [(0,), (3,), (4,), (5,)]
    assert stream.decided(7).isEmpty() and [r[0] for r in stream.decided(9).collect()] == [6]
    assert stream.ranks(7).where("user_id = 2").first()["pv_own"] == 500
    stream.batch(spark.createDataFrame([], ORDERS), 2)
    assert len(stream.commits()) == 4


def test_state_is_written_in_full_at_times(spark, trees, tmp_path, monkeypatch):
    monkeypatch.setattr("arborpay.streaming.order_stream.CHANGES", 1)
    stream = OrderStream(spark, f"{tmp_path}/s", *trees)
    for k in range(3):
        stream.batch(spark.createDataFrame([(k, 7, 3, 100, k)], ORDERS), k)
    assert [c.full for c in stream.commits()] == [(7,), (), (7,)]
    changed = spark.read.parquet(f"{tmp_path}/s/ranks/period=7/commit=2")
    assert 0 < changed.count() < 6  # the buyer and those above
    stream.vacuum()
    assert stream.files.names(f"{tmp_path}/s/ranks/period=7") == ["commit=3"]
    assert stream.ranks(7).where("user_id = 3").first()["pv_own"] == 300
