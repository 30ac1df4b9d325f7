"""Order events as a stream with state: ranks and leg volumes of open periods, and what changed, in one commit.

A micro-batch writes what it changes, each table in a folder with the commit's number: ranks, legs, the orders it
decided, refused orders, and an event per member whose rank changed. One empty file, created at the end, commits
all of them; its name holds the number, the batch and the kind. What lies there without a commit is never
read, and a batch whose commit is there is skipped, so a replay changes nothing and an event is there exactly
when the state that it tells of is there.

Reads take the last full commit of a period and the changes after it. Orders are remembered, accepted or
not, until their period closes. One stream writes; consumers of events each have a cursor.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from arborpay.operators import elite
from arborpay.sources.files import Files
from arborpay.sources.versions import PeriodRuns
from arborpay.sources.workspace import Workspace
from arborpay.streaming import changes, incremental

ORDERS = "order_id long, period int, user_id long, pv long, event_ts long"
LEGS = "user_id long, pv_1l long, pv_2l long"
EVENTS = "event_key string, event_type string, period int, user_id long, old_value int, new_value int"
#: Commits of changes after which a period's state is written in full.
CHANGES = 8
#: Types of events; fixed values.
RANK_CHANGED, PERIOD_DONE = "RANK_CHANGED", "SETTLEMENT_PERIOD_DONE"


class Commit(NamedTuple):
    number: int
    source: str  # b and a batch's id, or s and the period that closes
    full: tuple[int, ...]  # periods whose state is written whole


class OrderStream:
    """State under one path, over two trees that stay as they are while a period is open."""

    def __init__(self, spark: SparkSession, path: str, sponsor: DataFrame, placement: DataFrame, runs: PeriodRuns | None = None):
        """``runs`` says which periods take orders; without it all do but those closed here."""
        self.spark, self.path, self.runs = spark, path.rstrip("/"), runs
        self.sponsor, self.placement = sponsor, placement
        self.files = Files(spark)

    def commits(self) -> list[Commit]:
        """All commits, in order."""
        names = (n.split("-") for n in self.files.names(f"{self.path}/commits"))
        return sorted(Commit(int(a), b, tuple(int(p) for p in c.split("_") if p)) for a, b, c in names)

    def _folder(self, table: str, number: int, period: int | None = None) -> str:
        return f"{self.path}/{table}/" + (f"commit={number}" if period is None else f"period={period}/commit={number}")

    def _write(self, rows: DataFrame, table: str, number: int, period: int | None = None) -> None:
        rows.write.mode("overwrite").parquet(self._folder(table, number, period))

    def _read(self, table: str, period: int, numbers: list[int], schema: str | T.StructType) -> DataFrame:
        """Rows of commits of a period, with ``commit``; the schema is what an empty list gives."""
        there = [n for n in numbers if self.files.exists(self._folder(table, n, period))]
        if not there:
            return self.spark.createDataFrame([], schema).withColumn("commit", F.lit(0))
        base = f"{self.path}/{table}/period={period}"
        return self.spark.read.option("basePath", base).parquet(*[f"{base}/commit={n}" for n in there])

    def _since(self, period: int) -> list[int]:
        """Numbers of the commits that the period's state is read from."""
        done = self.commits()
        full = max((c.number for c in done if period in c.full), default=0)
        return [c.number for c in done if c.number >= full] if full else []

    def _state(self, table: str, period: int, schema: str) -> DataFrame:
        rows = self._read(table, period, self._since(period), schema)
        rest = [c for c in rows.columns if c not in ("user_id", "commit")]
        return rows.groupBy("user_id").agg(F.max_by(F.struct(*rest), "commit").alias("v")).select("user_id", "v.*")

    def ranks(self, period: int) -> DataFrame:
        """The rank of every member; of a period without orders, of no volume."""
        if not self._since(period):
            return elite.rank_snapshot(Workspace(self.spark, "blank"), self.sponsor, self.spark.createDataFrame([], "user_id long, pv_own long"))
        return self._state("ranks", period, LEGS)

    def legs(self, period: int) -> DataFrame:
        """(user_id, pv_1l, pv_2l) of members with buyers below them."""
        return self._state("legs", period, LEGS)

    def decided(self, period: int) -> DataFrame:
        """(order_id, accepted) of a period that is open."""
        return self._read("decided", period, [c.number for c in self.commits()], "order_id long, accepted boolean").select("order_id", "accepted")

    def refused(self) -> DataFrame:
        """Orders that came for a period that doesn't take any."""
        there = [self._folder("refused", c.number) for c in self.commits() if self.files.exists(self._folder("refused", c.number))]
        return self.spark.read.parquet(*there) if there else self.spark.createDataFrame([], ORDERS)

    def closed(self, period: int) -> bool:
        """Whether a period takes no orders."""
        return any(c.source == f"s{period}" for c in self.commits()) or (self.runs is not None and not self.runs.writable(period))

    def _commit(self, number: int, source: str, full: list[int]) -> None:
        self.files.create(f"{self.path}/commits/{number:012d}-{source}-{'_'.join(map(str, full))}")

    def _period(self, ws: Workspace, period: int, orders: DataFrame, number: int) -> tuple[DataFrame, bool]:
        """Write a period's part of a batch; its events, and whether the state was written in full."""
        known = self.decided(period)
        # The ids of all earlier orders aren't shuffled where those of the batch are few enough to go to them.
        again = known.join(orders.select("order_id").distinct().hint("merge"), "order_id", "left_semi").select("order_id")
        old, legs = ws.table(self.ranks(period), "ranks-before"), ws.table(self.legs(period), "legs-before")
        got = incremental.apply_batch(ws, old, legs, self.sponsor, self.placement, orders, again)
        new, new_legs = ws.table(got.ranks, "ranks-after"), ws.table(got.legs, "legs-after")
        numbers = self._since(period)
        full = not numbers or len(numbers) > CHANGES
        for name, before, after in (("ranks", old, new), ("legs", legs, new_legs)):
            self._write(after if full else _changed(before, after), name, number, period)
        accepted = got.applied.join(again.hint("merge"), "order_id", "left_anti").select("order_id", F.lit(True).alias("accepted"))
        self._write(accepted.unionByName(got.rejected.select("order_id", F.lit(False).alias("accepted"))), "decided", number, period)
        moved = changes.diff(old, new, "user_id", "rank")
        key = F.concat_ws(":", F.lit(period), F.col("user_id"), F.lit(number))
        return moved.select(key.alias("event_key"), F.lit(RANK_CHANGED).alias("event_type"), F.lit(period).alias("period"), "user_id", F.col("old_value").cast("int"), F.col("new_value").cast("int")), full

    def batch(self, orders: DataFrame, batch: int) -> None:
        """One micro-batch (order_id, period, user_id, pv, event_ts), as foreachBatch calls it. Rows without order or period are refused."""
        if any(c.source == f"b{batch}" for c in self.commits()):
            return
        ws = Workspace(self.spark, "orders")
        rows = ws.table(orders.select("order_id", "period", "user_id", F.col("pv").cast("long").alias("pv"), "event_ts"), "batch")
        number = self.files.claim(f"{self.path}/claims")
        # Few periods are open at a time; those of rows that come late are told apart by the store alone.
        periods = [r[0] for r in rows.select("period").distinct().collect() if r[0] is not None]
        taken = [p for p in periods if not self.closed(p)]
        bad = F.col("order_id").isNull() | ~F.coalesce(F.col("period").isin(taken) if taken else F.lit(False), F.lit(False))
        late = rows.where(bad)
        if not late.isEmpty():
            self._write(late, "refused", number)
        events, full = None, []
        for period in sorted(taken):
            own = rows.where((F.col("period") == period) & F.col("order_id").isNotNull()).drop("period")
            told, whole = self._period(ws, period, own, number)
            events = told if events is None else events.unionByName(told)
            full += [period] if whole else []
        if events is not None:
            self._write(events, "events", number)
        self._commit(number, f"b{batch}", full)

    def start(self, stream: DataFrame, **trigger) -> StreamingQuery:
        return stream.writeStream.foreachBatch(self.batch).option("checkpointLocation", f"{self.path}/checkpoint").trigger(**(trigger or {"availableNow": True})).start()

    def close(self, period: int) -> None:
        """Take no more orders for a period, say so by an event, and forget which orders it had. Again does nothing more."""
        if not any(c.source == f"s{period}" for c in self.commits()):
            number = self.files.claim(f"{self.path}/claims")
            done = [(f"{period}:done", PERIOD_DONE, period, None, None, None)]
            self._write(self.spark.createDataFrame(done, EVENTS).coalesce(1), "events", number)
            self._commit(number, f"s{period}", [])
        self.files.delete(f"{self.path}/decided/period={period}")

    def events(self, number: int) -> DataFrame:
        """The events of a commit."""
        at = self._folder("events", number)
        return self.spark.read.parquet(at) if self.files.exists(at) else self.spark.createDataFrame([], EVENTS)

    def cursor(self, consumer: str) -> int:
        """The last commit whose events a consumer has."""
        return max((int(n) for n in self.files.names(f"{self.path}/cursors/{consumer}")), default=0)

    def deliver(self, consumer: str, send: Callable[[DataFrame, int], None]) -> int:
        """Hand every commit's events that a consumer lacks to it, in order; how many commits that were.

        The cursor moves after a commit is sent. One that is sent and then stopped is sent again, whole, with the
        same number and the same event keys; into() takes it once.
        """
        after, sent = self.cursor(consumer), 0
        for commit in self.commits():
            if commit.number > after:
                send(self.events(commit.number), commit.number)
                self.files.create(f"{self.path}/cursors/{consumer}/{commit.number:012d}", replace=True)
                self.files.delete(f"{self.path}/cursors/{consumer}/{after:012d}")
                after, sent = commit.number, sent + 1
        return sent

    def vacuum(self) -> list[int]:
        """Delete what a stopped batch left without a commit and state that no read takes; the numbers of stopped batches."""
        done = {c.number for c in self.commits()}
        last = max(done, default=0)
        lost = [int(n) for n in self.files.names(f"{self.path}/claims") if int(n) < last and int(n) not in done]
        for number in lost:
            for table in ("refused", "events"):
                self.files.delete(self._folder(table, number))
        for table in ("ranks", "legs", "decided"):
            for name in self.files.names(f"{self.path}/{table}"):
                period = int(name.partition("=")[2])
                first = 0 if table == "decided" else min(self._since(period), default=0)
                for folder in self.files.names(f"{self.path}/{table}/{name}"):
                    number = int(folder.partition("=")[2])
                    if number in lost or number < first:
                        self.files.delete(self._folder(table, number, period))
        return lost


def _changed(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows that weren't there or differ."""
    rest = [c for c in after.columns if c != "user_id"]
    was = before.select("user_id", F.struct(*rest).alias("_was"))
    return after.join(was.hint("merge"), "user_id", "left").where(~F.struct(*rest).eqNullSafe(F.col("_was"))).select(after.columns)


def into(path: str) -> Callable[[DataFrame, int], None]:
    """A consumer that keeps events in a table, in a folder by commit: what is sent again replaces itself."""

    def send(events: DataFrame, number: int) -> None:
        events.write.mode("overwrite").parquet(f"{path.rstrip('/')}/commit={number}")

    return send


def net_changes(events: DataFrame) -> DataFrame:
    """(period, user_id, old_value, new_value) over all rank events of a member in the order of commits, where these differ."""
    ranks = events.where(F.col("event_type") == RANK_CHANGED)
    rows = ranks.groupBy("period", "user_id").agg(F.min_by("old_value", "commit").alias("old_value"), F.max_by("new_value", "commit").alias("new_value"))
    return rows.where("old_value <> new_value")
