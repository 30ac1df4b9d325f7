"""Registered queries: each settles what it needs of a period and returns decimals in currency units."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborpay.functions.config import DEFAULTS, Config
from arborpay.functions.ids import numbered
from arborpay.functions.money import ordinal_id, previous_period, to_decimal, truncated, unscaled_decimal
from arborpay.operators import bonuses, checks, elite, honor, tree, volume
from arborpay.plans.settlement import Settlement, tree_depths
from arborpay.sources.domain import load, ragged_sponsor
from arborpay.sources.merge_table import MergeTable
from arborpay.sources.versions import PeriodRuns, VersionedTable, back_up, of_period
from arborpay.sources.workspace import Workspace
from arborpay.streaming import changes, incremental
from arborpay.streaming.order_stream import OrderStream, into, net_changes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def settled(f: Callable[[Settlement], DataFrame]) -> Query:
    """Register a query that is a function of the settlement."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(Settlement(load(spark, sf_dir)))

    QUERIES[f.__name__] = run
    return run


def money(df: DataFrame, *columns: str, **scales: int) -> DataFrame:
    """df with the named cents as decimals; keywords give another scale."""
    return df.withColumns({c: to_decimal(c) for c in columns} | {c: to_decimal(c, s) for c, s in scales.items()})


@settled
def level_fee_commission(s: Settlement) -> DataFrame:
    return money(s.level_fees(), "commission")


@settled
def sponsor_depth(s: Settlement) -> DataFrame:
    return tree_depths(s)


@settled
def generation_counts(s: Settlement) -> DataFrame:
    return tree.descendant_counts(s.placement)


@settled
def placement_closure(s: Settlement) -> DataFrame:
    return tree.closure(s.ws, s.d.placement, carry=("leg",))


@settled
def buyer_ancestors(s: Settlement) -> DataFrame:
    return tree.ancestors(s.ws, s.d.sponsor, s.own)


@settled
def direct_children(s: Settlement) -> DataFrame:
    rows = tree.children(s.d.sponsor, s.own)
    return rows.select("parent_id", F.concat_ws(",", F.transform("children", lambda c: c.cast("string"))).alias("children"))


@settled
def placement_pv(s: Settlement) -> DataFrame:
    return money(volume.leg_volume(s.ws, s.placement, s.own), "pv_1l", "pv_2l")


@settled
def placement_pv_by_closure(s: Settlement) -> DataFrame:
    return money(volume.leg_volume_by_closure(tree.closure(s.ws, s.d.placement, carry=("leg",)), s.own), "pv_1l", "pv_2l")


@settled
def team_pv(s: Settlement) -> DataFrame:
    return money(s.team.select("user_id", "depth", "pv_own", "pv_team", F.col("below").alias("buyers_below")), "pv_own", "pv_team")


@settled
def monthly_performance(s: Settlement) -> DataFrame:
    names = [c for c in s.month.columns if c.startswith(("pv", "pre", "total", "stock"))]
    return money(s.month, *names)


@settled
def placement_settlement(s: Settlement) -> DataFrame:
    rows = s.placement_settled()
    return money(rows, *[c for c in rows.columns if c != "user_id"])


@settled
def elite_bonus(s: Settlement) -> DataFrame:
    return money(s.part("e"), "gpv_real", "bonus_e")


@settled
def elite_bonus_source(s: Settlement) -> DataFrame:
    return money(elite.elite_sources(s.ws, s.elite_net), "source_pv")


@settled
def elite_bonus_source_resting(s: Settlement) -> DataFrame:
    return money(elite.elite_sources(s.ws, s.elite_net, resting=True), "source_pv")


@settled
def elite_level(s: Settlement) -> DataFrame:
    return money(s.levels, "gpv", "gpv_real", "gpv_unreal")


@settled
def rank_snapshot(s: Settlement) -> DataFrame:
    return money(s.ranks.select("user_id", "parent_id", "gpv", "legs", "virtual_width", "is_elite", "contrib", "rank"), "gpv", "contrib")


@settled
def highest_rank(s: Settlement) -> DataFrame:
    return elite.highest_rank(s.ranks, s.ranks_before)


@settled
def pro_elite_bonus(s: Settlement) -> DataFrame:
    return money(s.part("pe"), "base", "bonus_pe")


@settled
def pro_elite_source(s: Settlement) -> DataFrame:
    return money(elite.pro_elite_sources(s.levels), "source_gpv", "source_unreal")


@settled
def super_elite_bonus(s: Settlement) -> DataFrame:
    return money(s.part("se"), "bonus_se")


@settled
def honor_level(s: Settlement) -> DataFrame:
    return s.honors


@settled
def honor_layer(s: Settlement) -> DataFrame:
    return money(s.honor_layers, "lb_pv")


@settled
def highest_honor(s: Settlement) -> DataFrame:
    return s.highest_honor()


@settled
def highest_honor_half_years(s: Settlement) -> DataFrame:
    return honor.highest_honor_by_half_years(s.d.history, s.d.members, s.d.period - 1)


@settled
def honor_rolling_counts(s: Settlement) -> DataFrame:
    return honor.rolling_counts(s.d.history)


@settled
def leadership_bonus(s: Settlement) -> DataFrame:
    return money(s._leadership[1], "ori_bonus_lb", "bonus_lb")


@settled
def leadership_detail(s: Settlement) -> DataFrame:
    rows = s._leadership[0].select("user_id", "layer", "region_id", "country_id", "lb_pv", "layer_pv", "lb_rate", "bonus_lb")
    return money(rows, "lb_pv", "layer_pv", "bonus_lb", lb_rate=6)


@settled
def team_bonus(s: Settlement) -> DataFrame:
    return money(s.part("tb"), "touch_pv", "surplus_1l", "surplus_2l", "bonus_tb", ori_base=4, base=4, tb_rate=6)


@settled
def team_carry_over(s: Settlement) -> DataFrame:
    return money(bonuses.team_carry(s.match, s.carry), "surplus_1l", "surplus_2l", "total_1l", "total_2l")


@settled
def performance_points(s: Settlement) -> DataFrame:
    return money(s.points, "total_gpv", "bonus_pb", "pb_pv")


@settled
def stockist_fee(s: Settlement) -> DataFrame:
    rows = s.part("sfb")
    return money(rows, *[c for c in rows.columns if c not in ("user_id", "country_id")])


@settled
def global_pool(s: Settlement) -> DataFrame:
    return money(s.part("gpb"), "bonus_head", "bonus_pv", "bonus_gpb")


@settled
def car_room_bonus(s: Settlement) -> DataFrame:
    return money(s.part("crb"), "ori_car", "bonus_car", "ori_room", "bonus_room", "bonus_crb")


@settled
def achievement_bonus(s: Settlement) -> DataFrame:
    return money(s.part("eab"), "gpv", "bonus_eab", "payable")


@settled
def total_bonus(s: Settlement) -> DataFrame:
    rows = s.total()
    return money(rows, *[c for c in rows.columns if "bonus" in c or c == "total_points"])


@settled
def total_bonus_ids(s: Settlement) -> DataFrame:
    """Total bonuses with ids of a stamp and the row's number, the largest bonus first."""
    rows = numbered(s.ws, s.total().select("user_id", "total_bonus"), [F.desc("total_bonus"), F.asc("user_id")])
    return money(rows.select(ordinal_id("199701", F.col("row_no")).alias("row_id"), "row_no", "user_id", "total_bonus"), "total_bonus")


@settled
def inactive_details(s: Settlement) -> DataFrame:
    rows = s.inactive()
    return money(rows, *[c for c in rows.columns if c not in ("user_id", "country_id")])


@settled
def country_share(s: Settlement) -> DataFrame:
    return money(volume.country_share(s.ws, s.sponsor, s.orders).withColumnRenamed("share_e4", "share"), "pv", share=4)


@settled
def country_share_lb(s: Settlement) -> DataFrame:
    rows = volume.country_share_of_leadership(volume.country_share(s.ws, s.sponsor, s.orders), s.d.members, s._leadership[1])
    return money(rows.withColumnRenamed("share_e4", "share"), "pv", "bonus_lb", share=4, bonus_global=6)


@settled
def descendants_below(s: Settlement) -> DataFrame:
    """Members below each of the root's grandchildren, by level, three levels deep."""
    rows = tree.descendants(s.ws, s.d.sponsor, s.sponsor.where("depth = 2"), deepest=3)
    return rows.groupBy(F.col("ancestor").alias("user_id"), "level").agg(F.count("*").alias("n"))


#: Pools for layers that occur in small data as well, at a rate that doesn't halve evenly in millionths.
OPEN_POOLS = {"globalPoolBonus10": "1.0333", "globalPoolBonus20": ".5001", "globalPoolBonus30": "2"}


def global_pool_low_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Settlement(load(spark, sf_dir, config=Config(list((DEFAULTS | OPEN_POOLS).items())))).part("gpb")
    return money(rows, "bonus_head", "bonus_pv", "bonus_gpb")


QUERIES["global_pool_low_layers"] = global_pool_low_layers


@settled
def effectiveness(s: Settlement) -> DataFrame:
    return money(s.effective(), "effect_pv")


@settled
def integrity_report(s: Settlement) -> DataFrame:
    return checks.integrity_report(s.ws, s.d.members, s.d.sponsor, s.d.placement, s.orders)


@settled
def integrity_report_planted(s: Settlement) -> DataFrame:
    """All checks over trees, members and orders with planted violations: none of the counts is 0."""
    key, far = F.col("user_id"), 10**9
    members = s.d.members.where("user_id % 97 <> 5")
    sponsor = s.d.sponsor.withColumn("parent_id", F.when(key % 211 == 3, key + far).otherwise(F.col("parent_id")))
    sponsor = sponsor.unionByName(s.d.sponsor.where("user_id % 83 = 2").withColumn("parent_id", F.lit(0).cast("long")))
    sponsor = sponsor.unionByName(s.d.sponsor.where("user_id = 1").select(F.lit(-1).cast("long").alias("user_id"), F.lit(0).cast("long").alias("parent_id")))
    leg = F.when(key % 89 == 7, 3).when(key % 89 == 8, None).otherwise(F.col("leg")).cast("int")
    placement = s.d.placement.select("user_id", F.when(key % 223 == 9, key + far).otherwise(F.col("parent_id")).alias("parent_id"), leg.alias("leg"))
    placement = placement.unionByName(s.d.placement.where("user_id % 79 = 4").select("user_id", F.lit(0).cast("long").alias("parent_id"), F.lit(1).alias("leg")))
    buyer = F.when(key % 101 == 1, key + far).otherwise(key)
    orders = s.orders.select(buyer.alias("user_id"), F.when(F.col("order_id") % 103 == 1, F.lit(far)).otherwise(F.col("stockist_id")).alias("stockist_id"))
    return checks.integrity_report(s.ws, members, s.ws.table(sponsor, "planted"), s.ws.table(placement, "planted"), orders)


@settled
def rank_change_events(s: Settlement) -> DataFrame:
    old, new = s.ranks_before.select("user_id", "rank"), s.ranks.select("user_id", "rank")
    return changes.diff(old, new, "user_id", "rank")


@settled
def honor_change_events(s: Settlement) -> DataFrame:
    """Rises of the highest honor."""
    rows = s.highest_honor()
    return changes.diff(rows.select("user_id", F.col("before").alias("honor")), rows.select("user_id", F.col("highest").alias("honor")), "user_id", "honor", only_up=True)


def _early_and_late(s: Settlement) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Own volume of nine orders in ten, the other orders as events, and no applied orders."""
    late = s.orders.where("order_id % 10 = 0").select("order_id", "user_id", "pv")
    return volume.own_volume(s.orders.where("order_id % 10 <> 0")), late, late.select("order_id").limit(0)


@settled
def rank_snapshot_incremental(s: Settlement) -> DataFrame:
    """The rank snapshot, a tenth of the orders applied as a micro-batch to the state that the others leave."""
    own, late, applied = _early_and_late(s)
    rows = incremental.apply_ranks(s.ws, elite.rank_snapshot(s.ws, s.sponsor, own), s.sponsor, incremental.new_orders(late, applied))
    return money(rows.select("user_id", "parent_id", "gpv", "legs", "virtual_width", "is_elite", "contrib", "rank"), "gpv", "contrib")


def _streamed(s: Settlement) -> OrderStream:
    """All orders of the period as three micro-batches, the second of which comes twice and again with the third, over no volume."""
    stream = OrderStream(s.ws.spark, s.ws.folder("order-stream"), s.sponsor, s.d.placement)
    orders = s.orders.select("order_id", "period", "user_id", "pv", F.col("order_id").alias("event_ts"))
    for batch, part in ((0, "order_id % 3 = 0"), (1, "order_id % 3 = 1"), (1, "order_id % 3 = 1"), (2, "order_id % 3 <> 0")):
        stream.batch(orders.where(part), batch)
    stream.close(s.d.period)
    return stream


@settled
def order_stream_state(s: Settlement) -> DataFrame:
    """Ranks and leg volumes of every member as a stream of orders leaves them."""
    stream = _streamed(s)
    legs = stream.legs(s.d.period).where("pv_1l <> 0 or pv_2l <> 0")
    rows = stream.ranks(s.d.period).join(legs.hint("merge"), "user_id", "left")
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("pv_1l", "pv_2l")})
    return money(rows.select("user_id", "gpv", "legs", "virtual_width", "is_elite", "contrib", "rank", "pv_1l", "pv_2l"), "gpv", "contrib", "pv_1l", "pv_2l")


@settled
def order_stream_events(s: Settlement) -> DataFrame:
    """What a consumer of the outbox has after the stream: each member's net change of rank."""
    stream, kept = _streamed(s), s.ws.folder("delivered")
    stream.deliver("query", into(kept))
    return net_changes(s.ws.spark.read.parquet(kept)).select("user_id", "old_value", "new_value")


@settled
def elite_bonus_incremental(s: Settlement) -> DataFrame:
    """The Elite bonus, likewise; every tenth order comes a second time as an order and its refund, which cancel out."""
    own, late, applied = _early_and_late(s)
    again = late.where("order_id % 100 = 0")
    extra = again.withColumn("order_id", -F.col("order_id") * 2 - 1).unionByName(again.select((-F.col("order_id") * 2 - 2).alias("order_id"), "user_id", (-F.col("pv")).alias("pv")))
    # Extra orders come before their refunds: refunds have the greater event time.
    events = late.unionByName(extra).withColumn("event_ts", (F.col("pv") < 0).cast("long"))
    net = elite.elite_net(s.ws, volume.team_volume(s.ws, s.sponsor, own))
    rows = incremental.apply_bonus(s.ws, net, s.sponsor, incremental.new_orders(events, applied))
    return money(elite.elite_bonus(rows, s.config.micro("eliteRate")), "gpv_real", "bonus_e")


@settled
def member_pages(s: Settlement) -> DataFrame:
    """The page after member 100 of depth 4, and that after child 50 of parent 16, by keyset; the row more than asked for shows that there are more."""
    by_depth = tree.page(s.sponsor, ("depth", "user_id"), (4, 100), 40).select(F.lit("depth").alias("by"), F.col("depth").cast("long").alias("key"), "user_id")
    by_parent = tree.page(s.sponsor, ("parent_id", "user_id"), (16, 50), 40).select(F.lit("parent").alias("by"), F.col("parent_id").alias("key"), "user_id")
    return by_depth.unionByName(by_parent)


@settled
def stockist_fee_from_backup(s: Settlement) -> DataFrame:
    """The stockist fee, kept by period and read from its period's folder."""
    path = s.ws.folder("backup")
    back_up({"stockist_fee": s.part("sfb")}, path, s.d.period)
    rows = of_period(s.spark, path, "stockist_fee", s.d.period)
    return money(rows, *[c for c in rows.columns if c not in ("user_id", "country_id")])


@settled
def published_members(s: Settlement) -> DataFrame:
    """Members as a gated version: published, published twice without some and rolled back each time."""
    table = VersionedTable(s.spark, s.ws.folder("members"))
    rows = s.d.members.select("user_id", "country_id", "member_level")
    table.publish(rows, "user_id", source=s.d.sponsor.select("user_id"))
    for k in (2, 3):  # each is withdrawn, and neither comes back
        table.publish(rows.where(f"user_id % {k} = 0"), "user_id")
        table.roll_back()
    return table.read(["user_id", "country_id", "member_level"])[0]


@settled
def performance_of_run(s: Settlement) -> DataFrame:
    """Performance and ranks published together as a period's run, read back from it."""
    runs = PeriodRuns(s.spark, s.ws.folder("runs"))
    run = runs.begin(s.d.period, first=True)
    runs.end(s.d.period, run, {"performance": s.month, "rank": s.ranks})
    rows = runs.read(s.d.period, "performance").select("user_id", "pv_own", "pv_team", "is_active")
    return money(rows.join(runs.read(s.d.period, "rank").select("user_id", "rank").hint("merge"), "user_id", "left"), "pv_own", "pv_team")


def _over_ragged_tree(f: Callable[[Settlement], DataFrame]) -> Query:
    """Register a query over the same orders and a deep, ragged sponsor tree."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        domain = load(spark, sf_dir)
        domain.sponsor = ragged_sponsor(spark, sf_dir)
        return f(Settlement(domain))

    QUERIES[f.__name__] = run
    return run


@_over_ragged_tree
def ragged_ranks(s: Settlement) -> DataFrame:
    """Ranks over a tree too deep for a job a level: the fold goes by heavy paths."""
    return money(s.ranks.select("user_id", "parent_id", "depth", "gpv", "legs", "virtual_width", "is_elite", "contrib", "rank"), "gpv", "contrib")


@_over_ragged_tree
def ragged_elite_net(s: Settlement) -> DataFrame:
    return money(s.elite_net.select("user_id", "parent_id", "depth", "gpv", "elite", "gpv_real"), "gpv", "gpv_real")


@_over_ragged_tree
def ragged_country_share(s: Settlement) -> DataFrame:
    return money(volume.country_share(s.ws, s.sponsor, s.orders).withColumnRenamed("share_e4", "share"), "pv", share=4)


def decimal_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances cut to one decimal toward zero, and read back from two's-complement bytes as a change stream sends them."""
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("user_id"), F.col("c_acctbal").cast("decimal(18,2)").alias("balance"))
    sent = F.base64(F.unhex(F.lpad(F.hex((F.col("balance") * 100).cast("long")), 16, "0")))
    return rows.select("user_id", truncated(F.col("balance"), 1).cast("decimal(18,1)").alias("cut"), unscaled_decimal(sent, 2).cast("decimal(18,2)").alias("read"), previous_period(F.col("user_id") % 12 + 199601, "yyyymm").alias("month_before"))


QUERIES["decimal_functions"] = decimal_functions


def cdc_merged_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same state by merging the events in three batches that aren't in event order; deleted rows are remembered between them."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    op = F.when(F.col("event_type") == "error", "d").when(F.col("event_type") == "signup", "c").otherwise("u")
    rows = events.select(F.col("user_id").alias("id"), op.alias("op"), F.col("ts").alias("event_ts"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), "value")
    table = VersionedTable(spark, Workspace(spark, "cdc").folder("state"))
    for batch in (2, 0, 1):
        table.merge(changes.newest(rows.where(F.col("offset") % 3 == batch), "id"))
    return table.read(["id", "event_ts", "value"])[0]


QUERIES["cdc_merged_state"] = cdc_merged_state


def decimal_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of 1 to 16 bytes, and longer ones that only repeat the sign, read from their two's complement."""
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("user_id"))
    size, negative = F.col("user_id") % 20 + 1, F.col("user_id") % 3 == 0
    body = F.substring(F.upper(F.sha2(F.col("user_id").cast("string"), 256)), F.lit(1), (F.least(size, F.lit(15)) * 2).cast("int"))
    sign = F.when(negative, "F").otherwise("0")
    sent = F.concat(F.repeat(sign, (F.greatest(size, F.lit(1)) % 5 * 2 + 2).cast("int")), body)
    return rows.select("user_id", unscaled_decimal(F.base64(F.unhex(sent)), 4).alias("read"))


QUERIES["decimal_bytes"] = decimal_bytes


def cdc_merge_on_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same state as a base and three deltas that are merged when they are read, of batches that aren't in event order; one comes twice."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    op = F.when(F.col("event_type") == "error", "d").when(F.col("event_type") == "signup", "c").otherwise("u")
    rows = events.select(F.col("user_id").alias("id"), op.alias("op"), F.col("ts").alias("event_ts"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), "value")
    table = MergeTable(spark, Workspace(spark, "cdc").folder("merged"))
    for batch in (4, 2):
        table.merge(changes.newest(rows.where(F.col("offset") % 5 == batch), "id"))
    table.compact()
    for batch in (0, 3, 1, 3):
        table.merge(changes.newest(rows.where(F.col("offset") % 5 == batch), "id"))
    return table.read(["id", "event_ts", "value"])[0]


QUERIES["cdc_merge_on_read"] = cdc_merge_on_read


def cdc_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest state of each user from the event stream as a change stream: errors delete, newest wins."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    op = F.when(F.col("event_type") == "error", "d").when(F.col("event_type") == "signup", "c").otherwise("u")
    rows = events.select(F.col("user_id").alias("id"), op.alias("op"), F.col("ts").alias("event_ts"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), "value", F.get_json_object("props", "$.k").cast("int").alias("k"))
    latest = changes.newest(rows, "id")
    return latest.where("op <> 'd'").select("id", "op", "event_ts", "offset", "value", "k")


QUERIES["cdc_latest_state"] = cdc_latest_state
