"""Honor levels, their rolling highest, and the bonuses by layer. Amounts are cents, rates millionths."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arborpay.functions.money import cut, of_rate, or_zero
from arborpay.operators import tree
from arborpay.operators.elite import by_region
from arborpay.sources.workspace import Workspace


def above(ws: Workspace, levels: DataFrame) -> DataFrame:
    """(user_id, se): the nearest member of level 30 above each, or ROOT."""
    up = tree.nearest(ws, levels.select("user_id", "parent_id"), levels.where("elite_level = 30"))
    return ws.table(up.withColumnRenamed("nearest", "se"), "above")


def layer_sources(ws: Workspace, levels: DataFrame, up: DataFrame) -> DataFrame:
    """(user_id, source_id, pv): the first layer's volume of each member of level 30.

    Real volume of a direct child goes one such member further up than that of others; virtual volume
    always goes to the nearest.
    """
    rows = levels.join(up.hint("merge"), "user_id")
    grand = up.select(F.col("user_id").alias("parent_id"), F.col("se").alias("grand"))
    rows = rows.where("top_deep > 0").join(grand.hint("merge"), "parent_id", "left")
    real = rows.select(F.when(F.col("se") == F.col("parent_id"), F.col("grand")).otherwise(F.col("se")).alias("user_id"), F.col("user_id").alias("source_id"), F.col("gpv_real").alias("pv"), F.lit(True).alias("is_real"))
    unreal = rows.where("gpv_unreal > 0").select(F.col("se").alias("user_id"), F.col("user_id").alias("source_id"), F.col("gpv_unreal").alias("pv"), F.lit(False).alias("is_real"))
    return ws.table(real.unionByName(unreal).where(F.col("user_id") != tree.ROOT), "layer-sources")


def climb(ws: Workspace, seeds: DataFrame, up: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(user_id, *by, layer, lb_pv): volumes of seeds (user_id, *by, lb_pv), layer 10 at home and 10 more a step up.

    ``up`` (user_id, se) holds the members a volume may pass; a step to anyone else ends its way. Each
    round sums what meets at a member, so a round has at most a row per member and group.
    """

    def step(front: DataFrame, _: int) -> DataFrame:
        above = front.join(up.hint("merge"), "user_id").select(F.col("se").alias("user_id"), *by, "layer", "lb_pv").join(up.select("user_id").hint("merge"), "user_id", "left_semi")
        return above.groupBy("user_id", *by).agg((F.max("layer") + 10).alias("layer"), F.sum("lb_pv").alias("lb_pv"))

    first = seeds.select("user_id", *by, F.lit(10).alias("layer"), F.col("lb_pv").cast("long").alias("lb_pv"))
    return tree.rounds(ws, first, step, "climb")


def chain_lengths(ws: Workspace, levels: DataFrame, up_all: DataFrame, active: DataFrame) -> DataFrame:
    """(user_id, se, length): the longest chain of level-30 members that ends at each, passing active members alone."""
    passing = up_all.join(active.select("user_id").hint("merge"), "user_id", "left_semi")

    def step(front: DataFrame, _: int) -> DataFrame:
        heads = front.groupBy(F.col("se").alias("user_id")).agg((F.max("length") + 1).alias("length"))
        return heads.join(passing.hint("merge"), "user_id").select("user_id", "se", "length")

    first = levels.where("elite_level = 30").select("user_id").join(up_all.hint("merge"), "user_id").select("user_id", "se", F.lit(1).alias("length"))
    return tree.rounds(ws, first, step, "chains").groupBy("user_id", "se").agg(F.max("length").alias("length"))


def honor_levels(ws: Workspace, levels: DataFrame, sources: DataFrame, members: DataFrame, limits: DataFrame, up_all: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(honors, layers).

    honors: depth of volume layers, legs of three, two and one members, the level before limits
    (``ori``), the member level's limit, what pays (``bonus``) and what lasts (``last``: no more than
    ten per member in the longest chain below). ``up_all`` is what above() gives. layers: (user_id, layer, lb_pv) up to ``ori``.
    """
    first = sources.groupBy("user_id").agg(F.sum("pv").alias("lb_pv")).where("lb_pv > 0")
    active = ws.table(first.join(levels.select("user_id").hint("merge"), "user_id", "left_semi"), "active")
    up = up_all.join(active.select("user_id").hint("merge"), "user_id", "left_semi")
    layers = ws.table(climb(ws, active, up), "layers")
    deepest = layers.groupBy("user_id").agg(F.max("layer").alias("legs_max"))
    chains = ws.table(chain_lengths(ws, levels, up_all, active), "chain")
    legs = chains.groupBy(F.col("se").alias("user_id")).agg(*[F.sum((F.col("length") >= k).cast("int")).alias(f"legs_{h}") for h, k in ((90, 3), (80, 2), (70, 1))])
    longest = chains.groupBy("user_id").agg(F.max("length").alias("length"))
    rows = deepest.join(legs.hint("merge"), "user_id", "left").join(longest.hint("merge"), "user_id", "left")
    rows = rows.select("user_id", "legs_max", *[or_zero(f"legs_{h}").cast("long").alias(f"legs_{h}") for h in (90, 80, 70)], F.greatest(or_zero("length") - 1, F.lit(0)).alias("chain"))
    ori = F.least(F.col("legs_max"), F.lit(60))
    for h in (70, 80, 90):
        ori = F.when((F.col("legs_max") >= h) & (F.col(f"legs_{h}") >= 3), h).otherwise(ori)
    rows = rows.withColumn("ori", ori.cast("int")).join(members.select("user_id", "member_level").hint("merge"), "user_id", "left").join(F.broadcast(limits), "member_level", "left")
    rows = rows.withColumn("bonus", F.when(F.col("ori") <= F.col("honor_limit"), F.col("ori")).otherwise(F.col("honor_limit")).cast("int"))
    rows = rows.withColumn("last", F.least(F.col("bonus"), F.col("chain") * 10).cast("int"))
    honors = ws.table(rows.select("user_id", "legs_max", "legs_90", "legs_80", "legs_70", "ori", F.col("honor_limit").cast("int").alias("honor_limit"), "bonus", "chain", "last"), "honors")
    paid = layers.join(honors.select("user_id", "ori", "bonus").hint("merge"), "user_id").where("layer <= ori").select("user_id", "layer", "lb_pv", "bonus")
    return honors, ws.table(paid, "honor-layers")


def highest_honor(members: DataFrame, honors: DataFrame, history: DataFrame, period: int) -> DataFrame:
    """The highest honor after this period, in three steps.

    Below 70 it follows the last one up to 70; at least 80 in two of the last twelve periods makes 80;
    90 in three of them makes 90. ``history`` counts from period - 11 on and from 80 up.
    """
    past = history.where(F.col("period").between(period - 11, period - 1) & (F.col("honor") >= 80)).select("user_id", "honor")
    record = past.unionByName(honors.select("user_id", F.col("last").alias("honor")))
    counts = record.groupBy("user_id").agg(F.sum((F.col("honor") >= 80).cast("int")).alias("n80"), F.sum((F.col("honor") == 90).cast("int")).alias("n90"))
    rows = members.select("user_id", F.col("honor_before").alias("before")).join(honors.select("user_id", "last").hint("merge"), "user_id", "left").join(counts.hint("merge"), "user_id", "left")
    one = F.when((F.col("before") < 70) & (F.col("before") < F.col("last")), F.least(F.col("last"), F.lit(70))).otherwise(F.col("before"))
    rows = rows.withColumn("one", one).withColumn("two", F.when((F.col("one") < 80) & (F.col("n80") >= 2), 80).otherwise(F.col("one")))
    rows = rows.withColumn("highest", F.when((F.col("two") < 90) & (F.col("n90") >= 3), 90).otherwise(F.col("two")).cast("int"))
    return rows.select("user_id", "before", or_zero("last").cast("int").alias("last"), "highest")


def highest_honor_by_half_years(history: DataFrame, members: DataFrame, period: int) -> DataFrame:
    """The older rule: the greatest of what was, the least of the last three periods, and the fourth best of the last six."""
    recent = history.where(F.col("period").between(period - 5, period)).select("user_id", "period", "honor")
    best = recent.groupBy("user_id").agg(F.sort_array(F.collect_list("honor"), asc=False).alias("all"), F.sum((F.col("period") > period - 3).cast("int")).alias("n3"), F.min(F.when(F.col("period") > period - 3, F.col("honor"))).alias("least3"))
    three = F.when(F.col("n3") == 3, F.col("least3")).otherwise(0)
    fourth = F.when(F.size("all") >= 4, F.element_at("all", 4)).otherwise(0)
    rows = members.select("user_id", F.col("honor_before").alias("before")).join(best.hint("merge"), "user_id", "left")
    return rows.select("user_id", "before", F.greatest("before", F.coalesce(three, F.lit(0)), F.coalesce(fourth, F.lit(0))).cast("int").alias("highest"))


def leadership(ws: Workspace, levels: DataFrame, sources: DataFrame, honors: DataFrame, members: DataFrame, regions: DataFrame, month: DataFrame, rates: DataFrame, up_all: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(details, bonuses) of the leadership bonus by region and layer.

    A layer's pool is its rate of the region's volume, cut at six decimals; so is the pool over the
    layer's volume. A bonus is cut per member, layer and source country. In the member's own region it is
    paid in the member's country.
    """
    active = ws.table(sources.groupBy("user_id").agg(F.sum("pv").alias("lb_pv")).where("lb_pv > 0").join(levels.select("user_id").hint("merge"), "user_id", "left_semi"), "lb-active")
    up = ws.table(up_all.join(active.select("user_id").hint("merge"), "user_id", "left_semi"), "lb-up")
    own = members.select(F.col("user_id").alias("source_id"), F.col("country_id"))
    seeds = sources.join(own.hint("merge"), "source_id", "left").groupBy("user_id", "country_id").agg(F.sum("pv").alias("lb_pv")).where("lb_pv > 0").join(levels.select("user_id").hint("merge"), "user_id", "left_semi")
    layers = climb(ws, seeds, up, by=("country_id",)).groupBy("user_id", "country_id", "layer").agg(F.sum("lb_pv").alias("lb_pv"))
    layers = layers.join(honors.select("user_id", "ori", "bonus").hint("merge"), "user_id").where("layer <= ori")
    layers = ws.table(by_region(layers, regions), "lb-layers")
    volume = by_region(month.groupBy("country_id").agg(F.sum("pv_own").alias("pv")), regions).groupBy("region_id").agg(F.sum("pv").alias("region_pv"))
    pools = layers.groupBy("region_id", "layer").agg(F.sum("lb_pv").alias("layer_pv")).where("layer_pv > 0").join(volume, "region_id", "left").join(F.broadcast(rates), "layer", "left")
    pools = pools.withColumn("pool", F.coalesce(cut(or_zero("region_pv"), or_zero("rate"), 100), F.lit(0))).withColumn("lb_rate", cut("pool", 100, "layer_pv"))
    rows = layers.join(pools.select("region_id", "layer", "layer_pv", "pool", "lb_rate"), ["region_id", "layer"], "left").withColumn("bonus_lb", of_rate("lb_pv", or_zero("lb_rate")))
    details = rows.groupBy("user_id", "layer", "region_id").agg(F.sum("lb_pv").alias("lb_pv"), F.max("bonus").alias("bonus_level"), F.max("layer_pv").alias("layer_pv"), F.max("pool").alias("pool"), F.max("lb_rate").alias("lb_rate"), F.sum("bonus_lb").alias("bonus_lb"))
    home = by_region(members.select("user_id", "country_id"), regions).select("user_id", F.col("country_id").alias("home"), F.col("region_id").alias("home_region"))
    details = details.join(home.hint("merge"), "user_id", "left").withColumn("country_id", F.when(F.col("region_id") == F.col("home_region"), F.col("home")).otherwise(F.col("region_id")))
    details = ws.table(details.drop("home", "home_region"), "lb-details")
    paid = F.coalesce(F.sum(F.when(F.col("layer") <= F.col("bonus_level"), F.col("bonus_lb"))), F.lit(0)).alias("bonus_lb")
    bonuses = details.groupBy("user_id", "country_id").agg(F.sum("bonus_lb").alias("ori_bonus_lb"), paid).where("bonus_lb > 0")
    return details, bonuses


def global_pool(layers: DataFrame, members: DataFrame, month: DataFrame, rates: DataFrame) -> DataFrame:
    """Each layer that ``rates`` (layer, rate) names shares its rate of all volume, half by heads and half by volume; founders count twice."""
    rows = layers.join(F.broadcast(rates.select("layer")), "layer", "left_semi").join(members.select("user_id", "is_founder").hint("merge"), "user_id").withColumn("heads", 1 + F.col("is_founder"))
    total = month.agg(or_zero(F.sum("pv_own")).alias("total"))
    pools = rows.groupBy("layer").agg(F.sum("heads").alias("n"), F.sum(F.col("lb_pv") * F.col("heads")).alias("pv")).join(F.broadcast(rates), "layer", "left").crossJoin(total)
    per_head = F.coalesce(cut("total", F.coalesce("rate", F.lit(0)), F.col("n") * 200), F.lit(0))
    per_pv = F.coalesce(cut(F.col("total").cast("decimal(38,0)") * F.coalesce("rate", F.lit(0)), 1, F.col("pv") * 2), F.lit(0))
    pools = pools.select("layer", per_head.alias("per_head"), per_pv.alias("per_pv"))
    rows = rows.join(pools, "layer").where("bonus >= layer")
    rows = rows.withColumn("by_head", cut("per_head", "heads", 10_000)).withColumn("by_pv", of_rate(F.col("lb_pv") * F.col("heads"), "per_pv"))
    active = month.select("user_id", "is_active")
    sums = rows.groupBy("user_id").agg(F.sum("by_head").alias("bonus_head"), F.sum("by_pv").alias("bonus_pv")).join(active.hint("merge"), "user_id", "left")
    return sums.select("user_id", "bonus_head", "bonus_pv", (F.col("bonus_head") + F.col("bonus_pv")).alias("bonus_gpb"), or_zero("is_active").alias("is_active"))


def rolling_counts(history: DataFrame, periods: int = 12) -> DataFrame:
    """For every period at once: how often a member was at 80 and at 90 in the periods up to it."""
    span = Window.partitionBy("user_id").orderBy("period").rangeBetween(-(periods - 1), 0)
    return history.select("user_id", "period", "honor", F.sum((F.col("honor") >= 80).cast("int")).over(span).alias("n80"), F.sum((F.col("honor") == 90).cast("int")).over(span).alias("n90"))
