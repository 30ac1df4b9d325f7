"""Elite rules: threshold folds over the sponsor tree, compressed nets, ranks and the bonuses on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborpay.functions.money import cut, of_rate, of_rate_of, or_zero
from arborpay.operators import tree
from arborpay.operators.paths import Rule, added
from arborpay.sources.workspace import Workspace

#: Group volume in cents that makes an Elite, and from which further Elites are virtual.
ELITE_PV, DOUBLE_PV = 100_000, 200_000


def elite_net(ws: Workspace, team: DataFrame) -> DataFrame:
    """Group volume by path A or B: whoever reaches ELITE_PV, or has a qualified child, qualifies.

    ``team`` is a team volume (user_id, parent_id, depth, pv_own). Unqualified group volume flows to the
    parent; a qualified member keeps its own.
    """
    gives = {"sum": (F.sum(F.when(F.col("elite") == 0, F.col("gpv"))), "long"), "qualified": (F.max("elite"), "int")}

    def takes(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("gpv", F.col("pv_own") + or_zero("sum"))
        rows = rows.withColumn("elite", F.when((F.col("gpv") >= ELITE_PV) | (or_zero("qualified") == 10), 10).otherwise(0))
        return rows.withColumn("gpv_real", F.when(F.col("elite") == 10, F.col("gpv")).otherwise(0).cast("long")).drop("sum", "qualified")

    def row(own: dict, given: dict) -> dict:
        gpv = own["pv_own"] + (given["sum"] or 0)
        elite = 10 if gpv >= ELITE_PV or given["qualified"] == 10 else 0
        return {"gpv": gpv, "elite": elite, "gpv_real": gpv if elite else 0}

    rule = Rule(row, lambda x: {"sum": None if x["elite"] else x["gpv"], "qualified": x["elite"]}, {"sum": added, "qualified": max})
    return ws.table(tree.fold(ws, team.select("user_id", "parent_id", "depth", "pv_own"), gives, takes, rule), "elite-net")


def elite_bonus(net: DataFrame, rate: int) -> DataFrame:
    """Bonus on the real group volume of qualified members."""
    rows = net.where("gpv_real > 0 and elite = 10")
    return rows.select("user_id", "parent_id", F.col("depth").alias("top_deep"), "gpv_real", of_rate("gpv_real", rate).alias("bonus_e"))


def elite_sources(ws: Workspace, net: DataFrame, resting: bool = False) -> DataFrame:
    """(source_id, bonus_id, source_pv): where each buyer's volume counts.

    The nearest qualified member from the buyer up; sources that nobody absorbs are left out, or with
    ``resting`` counted for the member at the top, where they come to rest.
    """
    hit = tree.nearest(ws, net.select("user_id", "parent_id"), net.where("elite = 10"), itself=True)
    rows = net.where("pv_own > 0").join(hit.hint("merge"), "user_id")
    if resting:
        at_top = net.where(F.col("parent_id") == tree.ROOT)
        roots = tree.nearest(ws, net.select("user_id", "parent_id"), at_top, itself=True).select("user_id", F.col("nearest").alias("top"))
        rows = rows.join(roots.hint("merge"), "user_id").withColumn("nearest", F.when(F.col("nearest") == tree.ROOT, F.col("top")).otherwise(F.col("nearest")))
    return rows.where(F.col("nearest") != tree.ROOT).select(F.col("user_id").alias("source_id"), F.col("nearest").alias("bonus_id"), F.col("pv_own").alias("source_pv"))


def level_net(ws: Workspace, team: DataFrame) -> DataFrame:
    """Group volume by path A alone, and what each member has hanging under it in the compressed net.

    ``hang`` counts kept members that hang on this one; ``kept`` members are those with real volume or at
    least two hanging.
    """
    gives = {"sum": (F.sum(F.when(F.col("real") == 0, F.col("gpv"))), "long"), "hanging": (F.sum("passes"), "long")}

    def takes(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("gpv", F.col("pv_own") + or_zero("sum")).withColumn("hang", or_zero("hanging"))
        rows = rows.withColumn("real", F.when(F.col("gpv") >= ELITE_PV, F.col("gpv")).otherwise(0).cast("long"))
        rows = rows.withColumn("kept", (F.col("real") > 0) | (F.col("hang") >= 2))
        return rows.withColumn("passes", F.when(F.col("kept"), F.lit(1)).otherwise(F.col("hang")).cast("long")).drop("sum", "hanging")

    def row(own: dict, given: dict) -> dict:
        gpv, hang = own["pv_own"] + (given["sum"] or 0), given["hanging"] or 0
        real = gpv if gpv >= ELITE_PV else 0
        kept = real > 0 or hang >= 2
        return {"gpv": gpv, "hang": hang, "real": real, "kept": kept, "passes": 1 if kept else hang}

    rule = Rule(row, lambda x: {"sum": None if x["real"] else x["gpv"], "hanging": x["passes"]}, {"sum": added, "hanging": added})
    return ws.table(tree.fold(ws, team.select("user_id", "parent_id", "depth", "pv_own"), gives, takes, rule), "level-net")


def elite_level(ws: Workspace, net: DataFrame) -> DataFrame:
    """The compressed net with Elite levels 10, 20 and 30.

    Kept members hang on their nearest kept ancestor. From the bottom up, a member without real volume
    takes over the smallest volume among its children (of equal ones that with the largest id).
    """
    kept = net.where("kept")
    up = tree.nearest(ws, net.select("user_id", "parent_id"), kept)
    double = F.col("real") >= DOUBLE_PV
    rows = kept.join(up.hint("merge"), "user_id").select(
        "user_id",
        F.col("nearest").alias("parent_id"),
        F.col("real").alias("gpv"),
        F.when(double, F.lit(ELITE_PV)).otherwise(F.col("real")).cast("long").alias("own_real"),
        F.when(double, F.col("real") - ELITE_PV).otherwise(0).cast("long").alias("gpv_unreal"),
        (F.col("hang") + F.when(double, F.floor(F.col("real") / ELITE_PV)).otherwise(0)).cast("long").alias("sons"),
    )
    rows = tree.depths(ws, ws.table(rows, "compressed"))
    least = F.min(F.struct(F.col("value"), (-F.col("user_id")).alias("last")))
    gives = {"least": (least, "struct<value: bigint, last: bigint>")}

    def takes(level: DataFrame) -> DataFrame:
        pulls = (F.col("own_real") == 0) & (F.col("sons") >= 2) & F.col("least").isNotNull()
        level = level.withColumn("value", F.when(pulls, F.col("least.value")).otherwise(F.col("own_real")))
        return level.withColumn("pulled", F.when(pulls, -F.col("least.last"))).drop("least")

    def row(own: dict, given: dict) -> dict:
        pulls = own["own_real"] == 0 and own["sons"] >= 2 and given["least"] is not None
        return {"value": given["least"]["value"] if pulls else own["own_real"], "pulled": -given["least"]["last"] if pulls else None}

    rule = Rule(row, lambda x: {"least": {"value": x["value"], "last": -x["user_id"]}}, {"least": lambda a, b: min(a, b, key=lambda x: (x["value"], x["last"]))})
    folded = ws.table(tree.fold(ws, rows, gives, takes, rule), "pushed")
    gone = folded.where("pulled is not null").select(F.col("pulled").alias("user_id"), F.lit(True).alias("gone"))
    out = folded.join(gone.hint("merge"), "user_id", "left")
    level = F.when(F.col("sons") > 2, 30).when(F.col("sons") == 0, 10).otherwise(20)
    real = F.when(F.col("gone"), 0).otherwise(F.col("value")).cast("long")
    return ws.table(out.select("user_id", "parent_id", F.col("depth").alias("top_deep"), "gpv", real.alias("gpv_real"), "gpv_unreal", "sons", level.alias("elite_level")), "elite-level")


def rank_of(elite: Column, width: Column) -> Column:
    """Rank by qualified width: 30 from three, 20 for an Elite with one or anyone with two, 10 for an Elite."""
    return F.when(width >= 3, 30).when((elite & (width >= 1)) | (~elite & (width >= 2)), 20).when(elite, 10).otherwise(0)


def ranked(rows: DataFrame) -> DataFrame:
    """rows with what follows from group volume and qualified legs: Elite, contribution, virtual width and rank."""
    rows = rows.withColumn("is_elite", F.col("gpv") >= ELITE_PV).withColumn("contrib", F.when(F.col("is_elite"), 0).otherwise(F.col("gpv")).cast("long"))
    rows = rows.withColumn("virtual_width", F.when(F.col("gpv") >= DOUBLE_PV, F.floor(F.col("gpv") / ELITE_PV)).otherwise(0).cast("long"))
    return rows.withColumn("rank", rank_of(F.col("is_elite"), F.col("legs") + F.col("virtual_width")))


def rank_snapshot(ws: Workspace, sponsor: DataFrame, own: DataFrame) -> DataFrame:
    """Rank of every member: group volume cut at ELITE_PV, qualified legs and virtual width."""
    nodes = tree.depths(ws, sponsor).join(own.select("user_id", "pv_own").hint("merge"), "user_id", "left").withColumn("pv_own", or_zero("pv_own").cast("long"))
    gives = {"sum": (F.sum("contrib"), "long"), "legs_in": (F.sum(((F.col("rank") >= 10) | (F.col("legs") >= 1)).cast("int")), "long")}

    def takes(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("gpv", F.col("pv_own") + or_zero("sum")).withColumn("legs", or_zero("legs_in"))
        return ranked(rows).drop("sum", "legs_in")

    def row(own: dict, given: dict) -> dict:
        gpv, legs = own["pv_own"] + (given["sum"] or 0), given["legs_in"] or 0
        is_elite, virtual = gpv >= ELITE_PV, gpv // ELITE_PV if gpv >= DOUBLE_PV else 0
        width = legs + virtual
        rank = 30 if width >= 3 else 20 if width >= (1 if is_elite else 2) else 10 if is_elite else 0
        return {"gpv": gpv, "legs": legs, "is_elite": is_elite, "contrib": 0 if is_elite else gpv, "virtual_width": virtual, "rank": rank}

    rule = Rule(row, lambda x: {"sum": x["contrib"], "legs_in": int(x["rank"] >= 10 or x["legs"] >= 1)}, {"sum": added, "legs_in": added})
    return ws.table(tree.fold(ws, nodes, gives, takes, rule), "ranks")


def highest_rank(now: DataFrame, before: DataFrame) -> DataFrame:
    """High-water mark of ranks, and whether it rose; both inputs (user_id, rank)."""
    rows = now.select("user_id", F.col("rank").alias("current_rank")).join(before.select("user_id", F.col("rank").alias("prev_highest")).hint("merge"), "user_id", "full_outer")
    rows = rows.select("user_id", or_zero("current_rank").alias("current_rank"), or_zero("prev_highest").alias("prev_highest"))
    top = F.greatest("current_rank", "prev_highest")
    return rows.select("user_id", "current_rank", "prev_highest", top.alias("highest_rank"), (top > F.col("prev_highest")).alias("rose"))


def pro_elite_bonus(levels: DataFrame, active: DataFrame, rate: int) -> DataFrame:
    """Members of level 20 and up: their compressed children's real volume plus their own virtual one."""
    kids = levels.groupBy(F.col("parent_id").alias("user_id")).agg(F.sum("gpv_real").alias("kids"))
    rows = levels.where("elite_level >= 20").join(kids.hint("merge"), "user_id", "left").join(active.select("user_id", "is_active").hint("merge"), "user_id", "left")
    base = or_zero("kids") + or_zero("gpv_unreal")
    return rows.select("user_id", base.alias("base"), of_rate(base, rate).alias("bonus_pe"), or_zero("is_active").alias("is_active"))


def pro_elite_sources(levels: DataFrame) -> DataFrame:
    """A row per child with real volume, and one for the member's own virtual volume."""
    bonus = levels.where("elite_level >= 20")
    kids = levels.where("gpv_real > 0").select(F.col("parent_id").alias("user_id"), F.col("user_id").alias("source_id"), F.col("gpv_real").alias("source_gpv"))
    first = bonus.select("user_id").join(kids.hint("merge"), "user_id").select("user_id", "source_id", "source_gpv", F.lit(0).cast("long").alias("source_unreal"))
    second = bonus.where("gpv_unreal > 0").select("user_id", F.col("user_id").alias("source_id"), F.lit(0).cast("long").alias("source_gpv"), F.col("gpv_unreal").alias("source_unreal"))
    return first.unionByName(second)


def by_region(rows: DataFrame, regions: DataFrame) -> DataFrame:
    """rows with region_id: that of their country, or the country itself where none is configured."""
    return rows.join(regions.select("country_id", "region_id"), "country_id", "left").withColumn("region_id", F.coalesce("region_id", "country_id"))


def super_elite_bonus(levels: DataFrame, members: DataFrame, regions: DataFrame, orders: DataFrame, active: DataFrame, rate: int) -> DataFrame:
    """A region's pool shared evenly among its members of level 30, active or not."""
    se = by_region(levels.where("elite_level = 30").select("user_id").join(members.select("user_id", "country_id").hint("merge"), "user_id"), regions)
    heads = se.groupBy("region_id").agg(F.count("*").alias("heads"))
    pool = by_region(orders.groupBy("country_id").agg(F.sum("pv").alias("pv")), regions).groupBy("region_id").agg(F.sum("pv").alias("pv"))
    share = heads.join(pool, "region_id").withColumn("bonus_se", cut("pv", rate, F.col("heads") * 1_000_000)).where("bonus_se > 0")
    rows = se.join(share, "region_id").join(active.select("user_id", "is_active").hint("merge"), "user_id", "left")
    return rows.select("user_id", "country_id", "region_id", "bonus_se", or_zero("is_active").alias("is_active"))


def performance_points(ws: Workspace, members: DataFrame, sponsor: DataFrame, net: DataFrame, month: DataFrame, before: DataFrame) -> DataFrame:
    """Points with differential levels 10, 20 and 30 at 20, 30 and 40 per cent.

    ``before`` has user_id and total_gpv accumulated in earlier periods. What a member's level doesn't
    take of the two 10 per cent steps goes up until it meets a level that does.
    """
    def level(total: Column) -> Column:
        return F.when(total >= 60_000, 30).when(total >= 30_000, 20).otherwise(10)

    rows = tree.depths(ws, sponsor).join(members.select("user_id", "country_id").hint("merge"), "user_id").join(net.select("user_id", "gpv", "elite", F.col("pv_own").alias("pv")).hint("merge"), "user_id", "left")
    rows = rows.join(month.select("user_id", "pv_team").hint("merge"), "user_id", "left").join(before.select("user_id", F.col("total_gpv").alias("earlier")).hint("merge"), "user_id", "left")
    total = or_zero("earlier") + or_zero("gpv")
    best = F.greatest(level(or_zero("earlier")), F.when(or_zero("pv_team") >= 60_000, 30).otherwise(10), level(total))
    rows = rows.select("user_id", "parent_id", "depth", "country_id", or_zero("gpv").cast("long").alias("gpv"), or_zero("pv").cast("long").alias("pv"), or_zero("elite").alias("elite"), best.alias("level"), total.cast("long").alias("total_gpv"))
    gives = {f"step{k}": (F.sum(F.when(F.col("elite") == 0, F.col(f"bonus_{k}"))), "long") for k in (20, 30)}

    def takes(nodes: DataFrame) -> DataFrame:
        under = F.col("gpv") < 100_000
        tenth = of_rate("pv", 100_000)
        own = of_rate("pv", F.col("level") * 10_000 + 100_000)
        nodes = nodes.withColumn("own", F.when(under, own).otherwise(0).cast("long"))
        nodes = nodes.withColumn("points", F.when(under, F.col("own") + F.when(F.col("level") >= 20, or_zero("step20")).otherwise(0) + F.when(F.col("level") >= 30, or_zero("step30")).otherwise(0)).otherwise(0).cast("long"))
        nodes = nodes.withColumn("bonus_20", F.when(under & (F.col("level") < 20), tenth + or_zero("step20")).otherwise(0).cast("long"))
        return nodes.withColumn("bonus_30", F.when(under & (F.col("level") < 30), tenth + or_zero("step30")).otherwise(0).cast("long")).drop("step20", "step30")

    def row(own: dict, given: dict) -> dict:
        if own["gpv"] >= 100_000:
            return {"own": 0, "points": 0, "bonus_20": 0, "bonus_30": 0}
        of = lambda rate: of_rate_of(own["pv"], rate)
        steps = {k: given[f"step{k}"] or 0 for k in (20, 30)}
        mine = of(own["level"] * 10_000 + 100_000)
        out = {"own": mine, "points": mine + sum(v for k, v in steps.items() if own["level"] >= k)}
        return out | {f"bonus_{k}": of(100_000) + v if own["level"] < k else 0 for k, v in steps.items()}

    rule = Rule(row, lambda x: {f"step{k}": None if x["elite"] else x[f"bonus_{k}"] for k in (20, 30)}, {"step20": added, "step30": added})
    return tree.fold(ws, rows, gives, takes, rule).where("points > 0").select("user_id", "country_id", "level", "total_gpv", F.col("points").alias("bonus_pb"), F.col("gpv").alias("pb_pv"))


def achievement_bonus(net: DataFrame, members: DataFrame, regions: DataFrame, orders: DataFrame, active: DataFrame, rate: int) -> DataFrame:
    """A region's pool shared evenly among its members with group volume of ELITE_PV, a half cent going up.

    Every eligible member has a row; payable is what is active and over 0.
    """
    who = by_region(net.where(F.col("gpv") >= ELITE_PV).select("user_id", "gpv").join(members.select("user_id", "country_id").hint("merge"), "user_id"), regions)
    heads = who.groupBy("region_id").agg(F.count("*").alias("heads"))
    pool = by_region(orders.groupBy("country_id").agg(F.sum("pv").alias("pv")), regions).groupBy("region_id").agg(F.sum("pv").alias("pv"))
    doubled = cut(F.col("pv").cast("decimal(38,0)") * 2 * rate + F.col("heads").cast("decimal(38,0)") * 1_000_000, 1, F.col("heads") * 2_000_000)
    share = heads.join(pool, "region_id", "left").withColumn("share", F.coalesce(doubled, F.lit(0)))
    rows = who.join(share, "region_id").join(active.select("user_id", "is_active").hint("merge"), "user_id", "left").withColumn("is_active", or_zero("is_active"))
    paid = F.when(F.col("is_active") == 1, F.col("share")).otherwise(0).cast("long")
    return rows.select("user_id", "gpv", "country_id", "region_id", F.col("share").alias("bonus_eab"), paid.alias("payable"), "is_active")


def with_rank(rows: DataFrame, by: str, order: list[Column]) -> DataFrame:
    """The first row of each group in an order."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where("_n = 1").drop("_n")
