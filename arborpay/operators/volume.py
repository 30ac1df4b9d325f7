"""Volumes of a period: own, team and leg volumes, carry-over, stockists and countries. Amounts are cents."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborpay.functions.money import cut, of_rate, or_zero
from arborpay.operators import paths, tree
from arborpay.sources.workspace import Workspace


def own_volume(orders: DataFrame) -> DataFrame:
    """(user_id, pv_own, pv_zc, pv_fx) of the members with orders."""

    def of(kind: str) -> F.Column:
        return F.coalesce(F.sum(F.when(F.col("dec_type") == kind, F.col("pv"))), F.lit(0)).alias(f"pv_{kind.lower()}")

    return orders.groupBy("user_id").agg(F.sum("pv").alias("pv_own"), of("ZC"), of("FX"))


def team_volume(ws: Workspace, edges: DataFrame, own: DataFrame, legs: bool = False) -> DataFrame:
    """Volume of each member's whole subtree, itself included, where any buyer is in it.

    Gives (user_id, parent_id, depth, pv_own, pv_team, below), ``below`` counting buyers underneath; with
    ``legs`` also pv_1l and pv_2l, the volumes under each leg.
    """
    nodes = tree.depths(ws, edges).join(own.select("user_id", "pv_own").hint("merge"), "user_id", "left").withColumn("pv_own", or_zero("pv_own").cast("long"))
    nodes = nodes.join(own.select("user_id", F.lit(1).cast("long").alias("below")).hint("merge"), "user_id", "left").withColumn("below", or_zero("below")).withColumn("pv_team", F.col("pv_own"))
    rows = tree.subtree_sums(ws, nodes, ["pv_team", "below"]).where("below > 0")
    rows = ws.table(rows.join(own.select("user_id", F.lit(1).cast("long").alias("buyer")).hint("merge"), "user_id", "left").withColumn("below", F.col("below") - or_zero("buyer")).drop("buyer"), "team")
    if legs:
        of = [F.coalesce(F.sum(F.when(F.col("leg") == k, F.col("pv_team"))), F.lit(0)).alias(f"pv_{k}l") for k in (1, 2)]
        rows = rows.join(rows.groupBy(F.col("parent_id").alias("user_id")).agg(*of).hint("merge"), "user_id", "left").withColumn("pv_1l", or_zero("pv_1l")).withColumn("pv_2l", or_zero("pv_2l"))
    return rows


def leg_volume(ws: Workspace, placement: DataFrame, own: DataFrame) -> DataFrame:
    """(user_id, pv_1l, pv_2l) of the members with buyers below them."""
    return team_volume(ws, placement, own, legs=True).where("below > 0").select("user_id", "pv_1l", "pv_2l")


def leg_volume_by_closure(closure: DataFrame, own: DataFrame) -> DataFrame:
    """The same from a closure (ancestor, descendant, leg), for callers that keep one."""
    joined = closure.join(own.select(F.col("user_id").alias("descendant"), "pv_own").hint("merge"), "descendant")

    def of(k: int) -> F.Column:
        return F.coalesce(F.sum(F.when(F.col("leg") == k, F.col("pv_own"))), F.lit(0)).alias(f"pv_{k}l")

    return joined.groupBy(F.col("ancestor").alias("user_id")).agg(of(1), of(2))


def monthly(ws: Workspace, orders: DataFrame, sponsor: DataFrame, placement: DataFrame, members: DataFrame, carry: DataFrame, active_pv: int, team: DataFrame | None = None) -> DataFrame:
    """Performance of a period: one row per member with own, team, leg or stockist volume.

    ``carry`` has user_id, surplus_1l and surplus_2l. Active is who bought at least ``active_pv`` or is listed.
    A team volume that is there already can be given.
    """
    own = ws.table(own_volume(orders), "own")
    team = (team_volume(ws, sponsor, own) if team is None else team).select("user_id", "pv_team")
    legs = leg_volume(ws, placement, own)
    stock = orders.where("stockist_id is not null").groupBy(F.col("stockist_id").alias("user_id")).agg(F.sum("pv").alias("stockist_pv"))
    users = own.select("user_id").union(team.select("user_id")).union(legs.select("user_id")).union(stock.select("user_id")).distinct()
    rows = users.join(own.hint("merge"), "user_id", "left").join(team.hint("merge"), "user_id", "left").join(legs.hint("merge"), "user_id", "left").join(stock.hint("merge"), "user_id", "left")
    rows = rows.join(carry.select("user_id", "surplus_1l", "surplus_2l").hint("merge"), "user_id", "left").join(members.select("user_id", "country_id", "listed_active").hint("merge"), "user_id", "left")
    amounts = [or_zero(c).cast("long").alias(c) for c in ("pv_own", "pv_zc", "pv_fx", "pv_team", "pv_1l", "pv_2l")]
    before = [or_zero(f"surplus_{k}l").cast("long").alias(f"pre_surplus_{k}l") for k in (1, 2)]
    totals = [(or_zero(f"pv_{k}l") + or_zero(f"surplus_{k}l")).cast("long").alias(f"total_{k}l") for k in (1, 2)]
    active = ((or_zero("pv_own") >= active_pv) | F.coalesce("listed_active", F.lit(False))).cast("int")
    return ws.table(rows.select("user_id", *amounts, *before, *totals, or_zero("stockist_pv").cast("long").alias("stockist_pv"), active.alias("is_active"), F.coalesce("country_id", F.lit(-1)).alias("country_id")), "monthly")


def placement_settlement(rows: DataFrame, before: DataFrame, now: DataFrame) -> DataFrame:
    """Leg totals after carry-over.

    ``rows``: new leg volumes; ``before``: remain_1l, remain_2l left by the period before; ``now``: own
    pv and gpv. Whoever was active gets total = new + carried; others keep what they carried.
    """
    users = rows.select("user_id").union(before.select("user_id")).union(now.select("user_id")).distinct()
    out = users.join(rows.hint("merge"), "user_id", "left").join(before.hint("merge"), "user_id", "left").join(now.hint("merge"), "user_id", "left")
    out = out.select("user_id", *[or_zero(c).cast("long").alias(c) for c in ("pv_1l", "pv_2l", "remain_1l", "remain_2l", "pv", "gpv")])
    busy = (F.col("pv") != 0) | (F.col("pv_1l") != 0) | (F.col("pv_2l") != 0) | (F.col("gpv") != 0)
    total = [F.when(busy, F.col(f"pv_{k}l") + F.col(f"remain_{k}l")).otherwise(0).cast("long").alias(f"total_{k}l") for k in (1, 2)]
    remain = [F.when(busy, F.lit(0)).otherwise(F.col(f"remain_{k}l")).cast("long").alias(f"remain_surplus_{k}l") for k in (1, 2)]
    out = out.select("user_id", "pv_1l", "pv_2l", F.col("remain_1l").alias("pre_surplus_1l"), F.col("remain_2l").alias("pre_surplus_2l"), *total, *remain)
    return out.where("pv_1l <> 0 or pv_2l <> 0 or pre_surplus_1l <> 0 or pre_surplus_2l <> 0")


def stockist_fee(orders: DataFrame, members: DataFrame, rate: int) -> DataFrame:
    """Fees of stockists by channel, each cut by itself."""

    def of(k: int, name: str) -> F.Column:
        return F.coalesce(F.sum(F.when(F.col("type_id") == k, F.col("pv"))), F.lit(0)).alias(name)

    names = {1: "unity", 2: "app", 3: "otc"}
    sums = orders.where("stockist_id is not null").groupBy(F.col("stockist_id").alias("user_id")).agg(F.sum("pv").alias("stockist_pv"), *[of(k, f"pv_{n}") for k, n in names.items()])
    rows = sums.where("stockist_pv > 0").select("*", *[of_rate(f"pv_{n}", rate).alias(f"bonus_{n}") for n in names.values()])
    rows = rows.withColumn("bonus_sfb", F.col("bonus_unity") + F.col("bonus_app") + F.col("bonus_otc")).where("bonus_sfb > 0")
    return rows.join(members.select("user_id", "country_id").hint("merge"), "user_id", "left")


def country_share(ws: Workspace, sponsor: DataFrame, orders: DataFrame) -> DataFrame:
    """By member and order country: volume, orders and buyers of the subtree, and the share of its volume.

    A fold over (member, country) sums: each level holds what its subtrees hold, once per country. A
    buyer stands in one place of the tree, so distinct buyers below add up. Deep trees go by heavy paths.
    """
    own = orders.groupBy("user_id", F.coalesce("country_id", F.lit(1)).alias("country_id")).agg(F.sum("pv").alias("pv"), F.count("*").alias("n_orders"), F.lit(1).cast("long").alias("n_users"))
    placed = ws.table(tree.depths(ws, sponsor), "share-depths")
    top = placed.agg(F.max("depth")).first()[0]
    if top is not None and top >= tree.DEEP:
        return _with_share(_shares_by_paths(ws, placed, ws.table(own.join(placed.hint("merge"), "user_id"), "share-own")))
    own = ws.table(own.join(placed.hint("merge"), "user_id"), "share-own", partition_by=("depth",))
    parents = placed.select("user_id", F.col("parent_id").alias("grand_id"))
    path, below = ws.folder("share"), None
    for depth in range(0 if top is None else top, -1, -1):
        rows = own.where(F.col("depth") == depth).select("user_id", "parent_id", "country_id", "pv", "n_orders", "n_users")
        if below is not None:
            up = below.join(parents.withColumnRenamed("user_id", "parent_id").hint("merge"), "parent_id").select(F.col("parent_id").alias("user_id"), F.col("grand_id").alias("parent_id"), "country_id", "pv", "n_orders", "n_users")
            rows = rows.unionByName(up)
        sums = rows.groupBy("user_id", "parent_id", "country_id").agg(*[F.sum(c).alias(c) for c in ("pv", "n_orders", "n_users")])
        below = ws.table_at(sums, f"{path}/{tree.STEP}={depth}")
    out = ws.spark.read.schema(below.schema).parquet(*[f"{path}/{tree.STEP}={k}" for k in range(0 if top is None else top, -1, -1)])
    return _with_share(out)


_SUMS = ("pv", "n_orders", "n_users")


def _walk_shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by path, the lowest member first, its countries together; a path's sums so far are held, a row per country."""
    path, at, sums = None, None, {}

    def rows() -> list[tuple]:
        return [(*at, country, *values) for country, values in sums.items()] if at else []

    for batch in batches:
        out: list[tuple] = []
        for new, member, up, country, *values in zip(*(batch.column(c).to_pylist() for c in ("path", "user_id", "_up", "country_id", *_SUMS)), strict=True):
            if at != (member, up):
                out += rows()
                if path != new:
                    sums = {}
                path, at = new, (member, up)
            if country is not None:
                sums[country] = [a + b for a, b in zip(sums.get(country, (0, 0, 0)), values, strict=True)]
        yield _shares(out)
    yield _shares(rows())


def _shares(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 6
    kinds = (pa.int64(), pa.int32(), pa.int64(), *[pa.int64()] * 3)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["user_id", "_up", "country_id", *_SUMS])


def _shares_by_paths(ws: Workspace, placed: DataFrame, own: DataFrame) -> DataFrame:
    """(user_id, parent_id, country_id, pv, n_orders, n_users) of the subtrees: paths as in paths.fold(), a row per member and country."""
    spots = paths.decompose(ws, placed.select("user_id", "parent_id")).withColumnsRenamed({"level": "_level", "up": "_up"})
    spot = ["user_id", "parent_id", "depth", "path", "_level", "_up"]
    bare = spots.select(*spot, F.lit(None).cast("long").alias("country_id"), *[F.lit(None).cast("long").alias(c) for c in _SUMS])
    bought = spots.join(own.drop("parent_id", "depth").hint("merge"), "user_id").select(*spot, F.col("country_id").cast("long").alias("country_id"), *_SUMS)

    def step(level: DataFrame, tops: DataFrame | None) -> DataFrame:
        if tops is not None:
            given = tops.groupBy(F.col("parent_id").alias("user_id"), "country_id").agg(*[F.sum(c).alias(c) for c in _SUMS])
            level = level.unionByName(given.join(level.where("country_id is null").select(*spot).hint("merge"), "user_id").select(level.columns))
        rows = level.repartition("path").sortWithinPartitions("path", F.desc("depth"))
        walked = rows.mapInArrow(_walk_shares, "user_id long, _up int, country_id long, pv long, n_orders long, n_users long")
        return walked.join(level.where("country_id is null").select("user_id", "parent_id").hint("merge"), "user_id")

    return paths.levels_of(ws, bare.unionByName(bought), step, "path-share")


def _with_share(out: DataFrame) -> DataFrame:
    team = out.groupBy("user_id").agg(F.sum("pv").alias("team"))
    share = F.coalesce(cut("pv", 10_000, "team"), F.lit(0)).alias("share_e4")
    return out.join(team.hint("merge"), "user_id").select("user_id", "parent_id", "country_id", "pv", "n_orders", "n_users", share)


def country_share_of_leadership(share: DataFrame, members: DataFrame, leadership: DataFrame) -> DataFrame:
    """The leadership bonus of each member, split by where the volume below it was ordered.

    ``share`` is what country_share() gives, ``leadership`` (user_id, bonus_lb) in cents; a member's bonuses in
    several countries each meet all its shares. The global bonus is in cents of 1/10000, exact.
    """
    paid = leadership.where("bonus_lb > 0").select("user_id", "bonus_lb")
    rows = share.join(paid.hint("merge"), "user_id").join(members.select("user_id", F.col("country_id").alias("home_id")).hint("merge"), "user_id", "left")
    return rows.select("user_id", F.col("country_id").alias("order_country"), F.col("home_id").alias("user_country"), "pv", "n_orders", "n_users", "share_e4", "bonus_lb", (F.col("bonus_lb") * F.col("share_e4")).alias("bonus_global"))
