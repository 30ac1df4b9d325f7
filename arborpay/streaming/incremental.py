"""Incremental settlement: order events change the state of a period as a full recomputation would.

State is a table per period. A micro-batch drops orders that were applied before, decides the rest one by
one, adds what is accepted to the members' own volume and recomputes only the members above them; everyone
else keeps their state.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborpay.functions.money import or_zero
from arborpay.operators import elite, tree
from arborpay.sources.workspace import Workspace


class Applied(NamedTuple):
    """What a micro-batch leaves: both states, the orders applied so far, and the batch's rejected orders."""

    ranks: DataFrame
    legs: DataFrame
    applied: DataFrame
    rejected: DataFrame


def new_orders(events: DataFrame, applied: DataFrame) -> DataFrame:
    """Events (order_id, user_id, pv, and event_ts where there is one) that weren't applied before; one row per order, the earliest."""
    rest = [c for c in events.columns if c not in ("order_id", "event_ts")]
    first = [c for c in ("event_ts",) if c in events.columns]
    rows = events.groupBy("order_id").agg(F.min(F.struct(*first, *rest)).alias("e")).select("order_id", "e.*").select(events.columns)
    return rows.join(applied.select("order_id").hint("merge"), "order_id", "left_anti")


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by member in order; only the balance of the member at hand is held."""
    member, balance = None, None
    for batch in batches:
        accepted = []
        for user, pv, start in zip(*(batch.column(c).to_pylist() for c in ("user_id", "pv", "pv_own")), strict=True):
            if user != member:
                member, balance = user, start
            good = balance is not None and balance + (pv or 0) >= 0
            if good:
                balance += pv or 0
            accepted.append(good)
        names = [n for n in batch.schema.names if n != "pv_own"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(accepted, pa.bool_())], [*names, "accepted"])


def decide(state: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders with ``accepted``: by event time and order_id, a refund that would make its member's own volume negative is not.

    Nor is an order of a member that the state doesn't know. What is accepted is accepted again from the same state.
    """
    by = [c for c in ("event_ts", "order_id") if c in orders.columns]
    rows = orders.withColumn("pv", F.col("pv").cast("long")).join(state.select("user_id", or_zero("pv_own").cast("long").alias("pv_own")).hint("merge"), "user_id", "left")
    rows = rows.select(*orders.columns, "pv_own")
    schema = rows.drop("pv_own").withColumn("accepted", F.lit(True)).schema
    return rows.repartition("user_id").sortWithinPartitions("user_id", *by).mapInArrow(_decide, schema)


def apply_batch(ws: Workspace, ranks: DataFrame, legs: DataFrame, sponsor: DataFrame, placement: DataFrame, events: DataFrame, applied: DataFrame) -> Applied:
    """Both states after a micro-batch: the same accepted orders go to ranks, leg volumes and the applied ones."""
    decided = ws.table(decide(ranks, new_orders(events, applied)), "decided")
    accepted = decided.where("accepted").drop("accepted")
    done = applied.select("order_id").unionByName(accepted.select("order_id"))
    return Applied(apply_ranks(ws, ranks, sponsor, accepted), apply_leg_volume(ws, legs, placement, accepted), done, decided.where("not accepted").drop("accepted"))


def affected(ws: Workspace, edges: DataFrame, members: DataFrame) -> DataFrame:
    """The members themselves and everyone above them."""
    up = tree.ancestors(ws, edges, members).select(F.col("ancestor").alias("user_id"))
    return members.select("user_id").union(up).distinct()


def apply_leg_volume(ws: Workspace, state: DataFrame, placement: DataFrame, orders: DataFrame) -> DataFrame:
    """Leg volumes (user_id, pv_1l, pv_2l) after orders: what is new adds up along the paths above the buyers."""
    own = orders.groupBy("user_id").agg(F.sum("pv").alias("pv"))
    up = tree.ancestors(ws, placement, own).where("level >= 1")
    # The leg under an ancestor is that of the path's last member below it.
    below = up.select("descendant", F.col("ancestor").alias("under"), (F.col("level") + 1).alias("level")).unionByName(own.select(F.col("user_id").alias("descendant"), F.col("user_id").alias("under"), F.lit(1).alias("level")))
    paths = up.join(below.hint("merge"), ["descendant", "level"]).join(placement.select(F.col("user_id").alias("under"), "leg").hint("merge"), "under")
    delta = paths.join(own.withColumnRenamed("user_id", "descendant").hint("merge"), "descendant")
    sums = delta.groupBy(F.col("ancestor").alias("user_id")).agg(*[F.coalesce(F.sum(F.when(F.col("leg") == k, F.col("pv"))), F.lit(0)).alias(f"d{k}") for k in (1, 2)])
    rows = state.join(sums.hint("merge"), "user_id", "full_outer")
    return rows.select("user_id", (or_zero("pv_1l") + or_zero("d1")).cast("long").alias("pv_1l"), (or_zero("pv_2l") + or_zero("d2")).cast("long").alias("pv_2l"))


def _refold(ws: Workspace, state: DataFrame, touched: DataFrame, side: DataFrame, gives: dict, takes) -> DataFrame:
    """The state with touched members (user_id) folded anew; ``side`` (user_id, ...) is what their other children give, by the names of ``gives``."""
    kept = state.join(touched.hint("merge"), "user_id", "left_anti")
    beside = side.join(touched.select(F.col("user_id").alias("child")).hint("merge"), "child", "left_anti").groupBy("user_id").agg(*[x.alias(f"side_{name}") for name, x in _again(gives).items()])
    own = ["user_id", "parent_id", "depth", "pv_own"]
    nodes = state.join(touched.hint("merge"), "user_id", "left_semi").select(*own).join(beside.hint("merge"), "user_id", "left")
    return kept.unionByName(tree.fold(ws, nodes, gives, takes).select(kept.columns))


def _again(gives: dict) -> dict[str, F.Column]:
    """Aggregates of what single children give: the same sums and maxima, by name."""
    return {name: (F.max if name == "qualified" else F.sum)(F.col(name)) for name in gives}


_RANKS = {"sum": (F.sum, lambda: F.col("contrib"), "long"), "legs_in": (F.sum, lambda: ((F.col("rank") >= 10) | (F.col("legs") >= 1)).cast("int"), "long")}
_BONUS = {"sum": (F.sum, lambda: F.when(F.col("elite") == 0, F.col("gpv")), "long"), "qualified": (F.max, lambda: F.col("elite"), "int")}


def _fold_of(ws: Workspace, state: DataFrame, touched: DataFrame, rules: dict, finish) -> DataFrame:
    gives = {name: (agg(value()), kind) for name, (agg, value, kind) in rules.items()}
    side = state.select(F.col("parent_id").alias("user_id"), F.col("user_id").alias("child"), *[value().alias(name) for name, (_, value, _) in rules.items()])

    def takes(rows: DataFrame) -> DataFrame:
        for name, (agg, _, _) in rules.items():
            both = F.greatest(name, f"side_{name}") if agg is F.max else or_zero(name) + or_zero(f"side_{name}")
            rows = rows.withColumn(name, both)
        return finish(rows).drop(*[c for name in rules for c in (name, f"side_{name}")])

    return _refold(ws, state, touched, side, gives, takes)


def _rank_of(rows: DataFrame) -> DataFrame:
    return elite.ranked(rows.withColumn("gpv", (F.col("pv_own") + F.col("sum")).cast("long")).withColumn("legs", F.col("legs_in").cast("long")))


def _bonus_of(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("gpv", (F.col("pv_own") + F.col("sum")).cast("long"))
    rows = rows.withColumn("elite", F.when((F.col("gpv") >= elite.ELITE_PV) | (or_zero("qualified") == 10), 10).otherwise(0))
    return rows.withColumn("gpv_real", F.when(F.col("elite") == 10, F.col("gpv")).otherwise(0).cast("long"))


def _after_orders(ws: Workspace, state: DataFrame, sponsor: DataFrame, orders: DataFrame, rules: dict, finish) -> DataFrame:
    accepted = decide(state, orders).where("accepted")
    sound = ws.table(accepted.groupBy("user_id").agg(F.sum("pv").alias("delta")), "sound")
    touched = ws.table(affected(ws, sponsor, sound), "touched")
    state = state.join(sound.hint("merge"), "user_id", "left").withColumn("pv_own", (or_zero("pv_own") + or_zero("delta")).cast("long")).select(state.columns)
    return _fold_of(ws, state, touched, rules, finish)


def apply_ranks(ws: Workspace, state: DataFrame, sponsor: DataFrame, orders: DataFrame) -> DataFrame:
    """Rank state after orders. Refunds are negative; each that would make a member's own volume negative is left out.

    Members above a buyer are folded anew from their children's state, the others are taken over.
    """
    return _after_orders(ws, state, sponsor, orders, _RANKS, _rank_of)


def apply_bonus(ws: Workspace, state: DataFrame, sponsor: DataFrame, orders: DataFrame) -> DataFrame:
    """The Elite net after orders, refunds as in apply_ranks(); the bonus follows from it by elite.elite_bonus().

    ``state`` is what elite.elite_net() gives: members with volume below them or of their own. Those that get
    their first volume come in. A refund can take away a qualification, so members above a buyer are folded
    anew; volume flows on to the next member above that no longer stops it.
    """
    placed = tree.depths(ws, sponsor)
    buyers = orders.select("user_id").distinct().join(placed.select("user_id").hint("merge"), "user_id", "left_semi")
    new = placed.join(affected(ws, sponsor, buyers).hint("merge"), "user_id", "left_semi").join(state.select("user_id").hint("merge"), "user_id", "left_anti")
    blank = [F.lit(0).cast(state.schema[c].dataType).alias(c) for c in state.columns if c not in ("user_id", "parent_id", "depth")]
    state = ws.table(state.unionByName(new.select("user_id", "parent_id", "depth", *blank)), "bonus-state")
    return _after_orders(ws, state, sponsor, orders, _BONUS, _bonus_of)


def move_member(edges: DataFrame, user_id: int, parent_id: int) -> DataFrame:
    """The tree after a member moved under another parent."""
    return edges.withColumn("parent_id", F.when(F.col("user_id") == user_id, F.lit(parent_id)).otherwise(F.col("parent_id")).cast("long"))


def patch(ws: Workspace, edges: DataFrame, moves: DataFrame) -> DataFrame:
    """The tree after moves (user_id, parent_id, and leg in a placement tree); one move a member.

    New members may come; a parent that is no member, a cycle, a leg other than 1 and 2 and a leg taken
    twice raise TreeError, and then nothing of the patch holds.
    """
    columns = ["user_id", "parent_id", *([c for c in ("leg",) if c in edges.columns])]
    new = ws.table(edges.select(columns).join(moves.select("user_id").hint("merge"), "user_id", "left_anti").unionByName(moves.select(columns)), "patched")
    if "leg" in columns:
        placed = tree.without_roots(new)
        twice = placed.groupBy("parent_id", "leg").count().where("count > 1").select(F.col("parent_id").alias("user_id"))
        wrong = placed.where("leg is null or leg not in (1, 2)").select("user_id").union(twice).limit(20).collect()
        if wrong:
            raise tree.TreeError(f"legs that don't fit: {[r[0] for r in wrong]}")
    return tree.depths(ws, new)


def apply_moves(ws: Workspace, state: DataFrame, old: DataFrame, new: DataFrame, moves: DataFrame) -> DataFrame:
    """Rank state after moves from the ``old`` sponsor tree to the ``new`` one, which patch() gives.

    Only the moved members and those above them, before or after, are folded anew; new members start
    with no volume. Depths change in whole subtrees and are taken over.
    """
    placed = new.select("user_id", "parent_id", "depth")
    fresh = placed.join(state.drop("parent_id", "depth").hint("merge"), "user_id", "left").select(state.columns)
    zero = [c for c in state.columns if c not in ("user_id", "parent_id", "depth", "is_elite")]
    fresh = ws.table(fresh.withColumns({c: F.coalesce(c, F.lit(0)).cast(state.schema[c].dataType) for c in zero}).withColumn("is_elite", F.coalesce("is_elite", F.lit(False))), "moved-state")
    touched = affected(ws, old, moves).union(affected(ws, new, moves)).distinct()
    return _fold_of(ws, fresh, ws.table(touched, "touched"), _RANKS, _rank_of)
