"""Binary match, car and room pools, commissions by level, totals and what inactive members miss."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborpay.functions.money import cut, half_up, or_zero
from arborpay.operators import tree
from arborpay.sources.workspace import Workspace


def level_fee(ws: Workspace, sponsor: DataFrame, orders: DataFrame, rates: DataFrame) -> DataFrame:
    """(user_id, level, commission): each order's amount times the rate of every level above its buyer, a half cent going up.

    A commission depends only on amount and rate, so equal amounts of a buyer go up as one row with their
    number; a round joins buyers' ancestors, not orders, one level further, only as far as there are rates
    (level, ppm).
    """
    top = rates.agg(F.max("level")).first()[0] or 0
    edges = ws.table(tree.without_roots(sponsor).select("user_id", "parent_id"), "fee-edges")
    sums = ws.table(orders.groupBy(F.col("user_id").alias("buyer"), "amount").agg(F.count("*").alias("n")), "fee-amounts")
    # What each buyer's orders give at a level: one row per buyer and rate, however many orders.
    given = sums.crossJoin(F.broadcast(rates)).groupBy("buyer", "level").agg(F.sum(half_up("amount", "ppm", 1_000_000) * F.col("n")).alias("commission"), F.sum("n").alias("n_orders"))
    path = sums.select("buyer", F.col("buyer").alias("user_id")).distinct()
    found = []
    for level in range(1, top + 1):
        path = ws.table(path.join(edges.hint("merge"), "user_id").select("buyer", F.col("parent_id").alias("user_id")), "fee-level")
        found.append(path.select("buyer", "user_id", F.lit(level).alias("level")))
    rows = reduce(DataFrame.unionByName, found).join(given.hint("merge"), ["buyer", "level"])
    return rows.groupBy("user_id", "level").agg(F.sum("commission").alias("commission"), F.sum("n_orders").alias("n_orders"))


def team_match(month: DataFrame, members: DataFrame, rates: DataFrame, caps: DataFrame) -> DataFrame:
    """Matched volume of the two legs and the base it gives, in 1/10000; bases are capped where a cap is set."""
    rows = month.join(members.select("user_id", "member_level").hint("merge"), "user_id", "left").join(F.broadcast(rates), "member_level", "left").join(F.broadcast(caps), "member_level", "left")
    touch = F.least("total_1l", "total_2l")
    rows = rows.select("user_id", "country_id", "is_active", "pv_own", "total_1l", "total_2l", (F.col("total_1l") - touch).alias("surplus_1l"), (F.col("total_2l") - touch).alias("surplus_2l"), touch.alias("touch_pv"), or_zero("rate").alias("rate"), (or_zero("cap") * 10_000).cast("long").alias("cap"))
    base = cut("touch_pv", "rate", 10_000)
    return rows.withColumn("ori_base", base).withColumn("base", F.when((F.col("cap") == 0) | (F.col("cap") > F.col("ori_base")), F.col("ori_base")).otherwise(F.col("cap")))


def team_bonus(match: DataFrame, bisect: int) -> DataFrame:
    """The pool, a rate of all volume, over the bases of active members; each share is cut to cents."""
    total = match.agg(or_zero(F.sum("pv_own")).alias("pv"), or_zero(F.sum(F.when((F.col("is_active") == 1) & (F.col("touch_pv") > 0), F.col("base")))).alias("bases"))
    total = total.select(F.coalesce(cut("pv", F.lit(bisect) * 100, "bases"), F.lit(0)).alias("tb_rate"))
    rows = match.where("touch_pv > 0 and base > 0 and is_active = 1").crossJoin(total).where("tb_rate > 0")
    return rows.select("user_id", "country_id", "touch_pv", "surplus_1l", "surplus_2l", "ori_base", "base", "tb_rate", cut("base", "tb_rate", 100_000_000).alias("bonus_tb"))


def team_carry(match: DataFrame, before: DataFrame) -> DataFrame:
    """What the next period starts with: matched members' surplus; others keep theirs as their total."""
    rows = before.select("user_id", F.col("surplus_1l").alias("b1"), F.col("surplus_2l").alias("b2")).join(match.select("user_id", "surplus_1l", "surplus_2l", "total_1l", "total_2l", F.lit(True).alias("seen")).hint("merge"), "user_id", "full_outer")
    seen = F.coalesce("seen", F.lit(False))

    def pick(new: str, old: str, name: str) -> F.Column:
        return F.when(seen, F.col(new)).otherwise(F.col(old)).cast("long").alias(name)

    return rows.select("user_id", pick("surplus_1l", "b1", "surplus_1l"), pick("surplus_2l", "b2", "surplus_2l"), pick("total_1l", "b1", "total_1l"), pick("total_2l", "b2", "total_2l"))


def enrolled_layers(ws: Workspace, net: DataFrame, enrolled: DataFrame, deepest: int = 6) -> DataFrame:
    """(user_id, source_id, gpv_real, layer): members below an enrolled one, whose layer counts only those with real volume.

    Walks down from the enrolled members; a member without real volume has no layer and adds none. A
    walk stops where nothing below can have a layer any more.
    """
    nodes = ws.table(net.select("user_id", "parent_id", "gpv", "real"), "crb-nodes")
    who = enrolled.select("user_id").distinct()

    def step(front: DataFrame, _: int) -> DataFrame:
        below = front.where(F.col("depth") < deepest).select("bonus_id", F.col("user_id").alias("parent_id"), "depth").join(nodes.hint("merge"), "parent_id")
        counts, next_ = F.col("real") > 0, (F.col("depth") + 1).cast("int")
        return below.select("bonus_id", "user_id", F.col("real").alias("gpv_real"), F.when(counts, next_).otherwise(0).alias("layer"), F.when(counts, next_).otherwise(F.col("depth")).alias("depth"))

    first = nodes.join(who.hint("merge"), "user_id", "left_semi").select(F.col("user_id").alias("bonus_id"), "user_id", F.col("gpv").alias("gpv_real"), F.lit(1).alias("layer"), F.lit(1).alias("depth"))
    out = tree.rounds(ws, first, step, "crb-front").where(F.col("layer").between(1, deepest))
    return out.select(F.col("bonus_id").alias("user_id"), F.col("user_id").alias("source_id"), "gpv_real", "layer")


def pool_by_layer(layers: DataFrame, enrolled: DataFrame, kind: str, pool: DataFrame, rates: DataFrame, period: int, active: DataFrame) -> DataFrame:
    """Shares of one enrolment's pool: each layer's rate of it over the layer's volume; capped, and 0 once it has ended."""
    mine = layers.join(enrolled.where(F.col("kind") == kind).select("user_id", "end_period", "capping").hint("merge"), "user_id")
    sums = mine.groupBy("layer").agg(F.sum("gpv_real").alias("total")).join(F.broadcast(rates), "layer").crossJoin(pool)
    sums = sums.withColumn("share", F.coalesce(cut(cut("pool", "rate", 200), 100, "total"), F.lit(0)))  # the pool counts half its volume
    rows = mine.join(sums.select("layer", "share"), "layer").withColumn("part", cut("gpv_real", "share", 1_000_000))
    pivot = [F.coalesce(F.sum(F.when(F.col("layer") == k, F.col("gpv_real"))), F.lit(0)).alias(f"layer_{k}") for k in range(1, 7)]
    out = rows.groupBy("user_id", "end_period", "capping").agg(F.sum("part").alias("ori_bonus"), *pivot).join(active.select("user_id", "is_active").hint("merge"), "user_id", "left")
    paid = F.when(F.col("end_period") < period, 0).otherwise(F.least("ori_bonus", "capping")).cast("long")
    return out.withColumn("bonus", paid).withColumn("is_active", or_zero("is_active"))


def car_room(ws: Workspace, net: DataFrame, enrolled: DataFrame, orders: DataFrame, active: DataFrame, car: DataFrame, room: DataFrame, period: int, countries: tuple[int, ...] = (1, 3, 4)) -> DataFrame:
    """Car and room bonuses together, of members who get either."""
    layers = ws.table(enrolled_layers(ws, net, enrolled), "crb-layers")
    pool = orders.where(F.col("country_id").isin(*countries)).agg(or_zero(F.sum("pv")).alias("pool"))
    a = pool_by_layer(layers, enrolled, "CAR", pool, car, period, active).select("user_id", F.col("ori_bonus").alias("ori_car"), F.col("bonus").alias("bonus_car"), F.col("is_active").alias("_a"))
    b = pool_by_layer(layers, enrolled, "ROOM", pool, room, period, active).select("user_id", F.col("ori_bonus").alias("ori_room"), F.col("bonus").alias("bonus_room"), F.col("is_active").alias("_b"))
    rows = a.join(b.hint("merge"), "user_id", "full_outer")
    rows = rows.select("user_id", *[or_zero(c).cast("long").alias(c) for c in ("ori_car", "bonus_car", "ori_room", "bonus_room")], F.coalesce("_a", "_b").alias("is_active"))
    return rows.where("bonus_car > 0 or bonus_room > 0").withColumn("bonus_crb", F.col("bonus_car") + F.col("bonus_room"))


#: Bonuses of a total: name, and whether it is paid to active members alone.
TOTAL = {"e": False, "pe": True, "se": True, "lb": True, "tb": True, "sfb": False, "gpb": True, "crb": True, "eab": True}


def total_bonus(parts: dict[str, DataFrame], points: DataFrame, month: DataFrame, members: DataFrame) -> DataFrame:
    """One row per member with a bonus or points; ``parts`` are (user_id, bonus_<name>) by the names of TOTAL."""
    rows = reduce(DataFrame.union, [p.select("user_id") for p in (*parts.values(), points)]).distinct()
    rows = rows.join(month.select("user_id", "is_active").hint("merge"), "user_id", "left").join(members.select("user_id", "country_id").hint("merge"), "user_id", "left")
    for name, part in parts.items():
        rows = rows.join(part.groupBy("user_id").agg(F.sum(f"bonus_{name}").alias(f"bonus_{name}")).hint("merge"), "user_id", "left")
    rows = rows.join(points.select("user_id", F.col("bonus_pb").alias("total_points")).hint("merge"), "user_id", "left").withColumn("is_active", or_zero("is_active"))
    for name, active_only in TOTAL.items():
        amount = or_zero(f"bonus_{name}")
        rows = rows.withColumn(f"bonus_{name}", (F.when(F.col("is_active") == 1, amount).otherwise(0) if active_only else amount).cast("long"))
    total = reduce(lambda x, y: x + y, [F.col(f"bonus_{n}") for n in TOTAL])
    rows = rows.withColumn("total_bonus", total).withColumn("total_points", or_zero("total_points").cast("long"))
    return rows.where("total_bonus > 0 or total_points > 0").select("user_id", "country_id", "is_active", "total_bonus", "total_points", *[f"bonus_{n}" for n in TOTAL])


def inactive_details(parts: dict[str, DataFrame], lb_details: DataFrame, points: DataFrame, month: DataFrame, members: DataFrame) -> DataFrame:
    """What inactive members would have got, with the leadership bonus by layer."""
    active = month.select("user_id", "is_active")
    due = [parts[n].select("user_id").join(active.hint("merge"), "user_id", "left").where("coalesce(is_active, 0) = 0").select("user_id") for n in ("pe", "se", "gpb", "crb", "eab")]
    paying = lb_details.where("layer <= bonus_level")
    due.append(paying.join(active.hint("merge"), "user_id").where("is_active = 0").select("user_id"))
    rows = reduce(DataFrame.union, due).distinct().join(members.select("user_id", "country_id").hint("merge"), "user_id", "left").join(month.select("user_id", "pv_own").hint("merge"), "user_id", "left")
    for name, part in parts.items():
        rows = rows.join(part.groupBy("user_id").agg(F.sum(f"bonus_{name}").alias(f"bonus_{name}")).hint("merge"), "user_id", "left").withColumn(f"bonus_{name}", or_zero(f"bonus_{name}").cast("long"))
    rows = rows.join(points.select("user_id", "bonus_pb").hint("merge"), "user_id", "left").withColumn("bonus_pb", or_zero("bonus_pb").cast("long"))
    layers = paying.groupBy("user_id").agg(*[F.coalesce(F.sum(F.when(F.col("layer") == k, F.col("bonus_lb"))), F.lit(0)).alias(f"lb{k}") for k in range(10, 100, 10)])
    rows = rows.join(layers.hint("merge"), "user_id", "left")
    return rows.select("user_id", "country_id", or_zero("pv_own").cast("long").alias("pv_own"), "bonus_pb", *[f"bonus_{n}" for n in TOTAL], *[or_zero(f"lb{k}").cast("long").alias(f"lb{k}") for k in range(10, 100, 10)])


def effectiveness(state: DataFrame, month: DataFrame, period_month: str, effective_pv: int) -> DataFrame:
    """Volume gathers until it reaches ``effective_pv``; from then on a member is effective for eleven months more.

    ``state`` has user_id, effect_month (yyyyMM text) and effect_pv; members without state start in
    this month.
    """
    rows = month.select("user_id", "pv_own").join(state.hint("merge"), "user_id", "left")
    gathered = or_zero("effect_pv") + F.col("pv_own")
    reached = gathered >= effective_pv
    since = F.when(reached, F.lit(period_month)).otherwise(F.coalesce("effect_month", F.lit(period_month)))
    active = F.add_months(F.to_date(F.concat(since, F.lit("01")), "yyyyMMdd"), 11) >= F.to_date(F.lit(period_month + "01"), "yyyyMMdd")
    return rows.select("user_id", since.alias("effect_month"), F.when(reached, 0).otherwise(gathered).cast("long").alias("effect_pv"), active.cast("int").alias("effect_active"))
