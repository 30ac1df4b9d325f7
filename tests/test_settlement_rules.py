"""Rules on small fixtures with values worked out by hand."""

import pytest
from pyspark.sql import functions as F

from arborpay.functions import money
from arborpay.functions.config import Config
from arborpay.operators import bonuses, checks, elite, honor, tree, volume

# The shared tree of thirteen members: child to parent.
SPONSOR = [(1, 3), (2, 3), (3, 4), (4, 5), (5, -1), (6, -1), (7, 8), (8, -1), (9, 1), (10, 2), (11, -1), (12, -1), (13, 1)]


@pytest.fixture(scope="module")
def sponsor(spark):
    return spark.createDataFrame(SPONSOR, "user_id long, parent_id long")


def ranks(spark, ws, sponsor, pv):
    own = spark.createDataFrame([(u, p * 100) for u, p in pv.items()], "user_id long, pv_own long")
    return {r["user_id"]: r for r in elite.rank_snapshot(ws, sponsor, own).collect()}


@pytest.mark.parametrize(
    "pv, expected",
    [
        ({13: 1000}, {13: (1000, 10, 0), 1: (0, 0, 1), 3: (0, 0, 1), 5: (0, 0, 1)}),
        ({9: 800}, {9: (800, 0, 0), 1: (800, 0, 0), 5: (800, 0, 0)}),
        ({10: 2000}, {10: (2000, 20, 0), 2: (0, 0, 1), 3: (0, 0, 1)}),
        ({13: 1000, 9: 800, 10: 2000}, {1: (800, 0, 1), 3: (800, 20, 2), 4: (800, 0, 1), 5: (800, 0, 1)}),
    ],
)
def test_rank_snapshot(spark, ws, sponsor, pv, expected):
    got = ranks(spark, ws, sponsor, pv)
    assert {u: (got[u]["gpv"] // 100, got[u]["rank"], got[u]["legs"]) for u in expected} == expected


@pytest.mark.parametrize("gpv, legs, rank, contrib", [(999, 0, 0, 999), (1000, 0, 10, 0), (1999, 0, 10, 0), (2000, 0, 20, 0), (3000, 0, 30, 0), (999, 2, 20, 999), (1000, 1, 20, 0), (999, 3, 30, 999)])
def test_rank_boundaries(spark, gpv, legs, rank, contrib):
    row = elite.ranked(spark.createDataFrame([(gpv * 100, legs)], "gpv long, legs long")).first()
    assert (row["rank"], row["contrib"]) == (rank, contrib * 100)


@pytest.mark.parametrize("pv, rate, expected", [({9: 1000}, 150_000, {9: 15000}), ({9: 800, 1: 200}, 150_000, {1: 15000}), ({1: 200, 9: 1000}, 156_000, {1: 3120, 9: 15600}), ({9: 1001}, 156_000, {9: 15615}), ({9: 500}, 150_000, {})])
def test_elite_bonus(spark, ws, sponsor, pv, rate, expected):
    own = spark.createDataFrame([(u, p * 100) for u, p in pv.items()], "user_id long, pv_own long")
    net = elite.elite_net(ws, volume.team_volume(ws, sponsor, own))
    assert {r["user_id"]: r["bonus_e"] for r in elite.elite_bonus(net, rate).collect()} == expected


def month(spark, rows):
    return spark.createDataFrame(rows, "user_id long, country_id int, total_1l long, total_2l long, pv_own long, is_active int")


@pytest.mark.parametrize(
    "rows, rate, cap, bisect, expected",
    [
        ([(1, 1, 100000, 60000, 10000, 1)], 100_000, 0, 240_000, {1: 2400}),
        ([(1, 1, 50000, 50000, 20000, 1)], 150_000, 0, 240_000, {1: 4800}),
        ([(1, 1, 2000000, 1000000, 100000, 1)], 200_000, 1500, 240_000, {1: 24000}),
        ([(1, 1, 100000, 100000, 10000, 0), (2, 1, 100000, 100000, 10000, 1)], 100_000, 0, 240_000, {2: 4800}),
        ([(1, 1, 6000, 6000, 100, 1)], 100_000, 0, 1_000_000, {1: 99}),
        ([(1, 1, 10**10, 10**10, 900, 1)], 100_000, 0, 1_000_000, {}),
    ],
)
def test_team_bonus(spark, rows, rate, cap, bisect, expected):
    members = spark.createDataFrame([(1, 10), (2, 10)], "user_id long, member_level int")
    rates = spark.createDataFrame([(10, rate)], "member_level int, rate long")
    caps = spark.createDataFrame([(10, cap)], "member_level int, cap long")
    match = bonuses.team_match(month(spark, rows), members, rates, caps)
    assert {r["user_id"]: r["bonus_tb"] for r in bonuses.team_bonus(match, bisect).collect()} == expected


def test_pro_elite(spark):
    rows = [(100, -1, 0, 50055, 20), (101, 100, 100044, 0, 10), (200, -1, 200000, 0, 10), (300, -1, 0, 100000, 30), (400, -1, 0, None, 20), (401, 400, 100000, 0, 10)]
    levels = spark.createDataFrame(rows, "user_id long, parent_id long, gpv_real long, gpv_unreal long, elite_level int")
    active = spark.createDataFrame([(100, 1), (300, 0)], "user_id long, is_active int")
    got = {r["user_id"]: (r["base"], r["bonus_pe"], r["is_active"]) for r in elite.pro_elite_bonus(levels, active, 150_000).collect()}
    assert got == {100: (150099, 22514, 1), 300: (100000, 15000, 0), 400: (100000, 15000, 0)}
    assert {tuple(r) for r in elite.pro_elite_sources(levels).where("user_id = 100").collect()} == {(100, 101, 100044, 0), (100, 100, 0, 50055)}


def test_super_elite_regions(spark):
    levels = spark.createDataFrame([(1, 30), (2, 30), (3, 30), (4, 20)], "user_id long, elite_level int")
    members = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, 1)], "user_id long, country_id int")
    regions = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "country_id int, region_id int")
    orders = spark.createDataFrame([(1, 100000), (2, 200000)], "country_id int, pv long")
    active = spark.createDataFrame([(1, 1)], "user_id long, is_active int")
    got = elite.super_elite_bonus(levels, members, regions, orders, active, 100_000).collect()
    assert sorted((r["user_id"], r["bonus_se"], r["region_id"], r["is_active"]) for r in got) == [(1, 10000, 1, 1), (2, 10000, 1, 0), (3, 10000, 1, 0)]


@pytest.mark.parametrize("heads, pv, share", [(2, 1_000_000, 50000), (3, 100_000, 3333), (1, 1235, 124)])
def test_achievement_rounds_half_up(spark, heads, pv, share):
    net = spark.createDataFrame([(u, 100000) for u in range(heads)], "user_id long, gpv long")
    members = spark.createDataFrame([(u, 1) for u in range(heads)], "user_id long, country_id int")
    regions = spark.createDataFrame([(1, 1)], "country_id int, region_id int")
    orders = spark.createDataFrame([(1, pv)], "country_id int, pv long")
    active = spark.createDataFrame([(0, 1)], "user_id long, is_active int")
    got = {r["user_id"]: (r["bonus_eab"], r["payable"]) for r in elite.achievement_bonus(net, members, regions, orders, active, 100_000).collect()}
    assert got == {u: (share, share if u == 0 else 0) for u in range(heads)}


def test_placement_settlement(spark):
    rows = spark.createDataFrame([(5, 30000, 40000)], "user_id long, pv_1l long, pv_2l long")
    before = spark.createDataFrame([(5, 100000, 20000), (4, 10000, 0)], "user_id long, remain_1l long, remain_2l long")
    now = spark.createDataFrame([(4, 0, 0)], "user_id long, pv long, gpv long")
    got = {r["user_id"]: (r["total_1l"], r["total_2l"], r["remain_surplus_1l"]) for r in volume.placement_settlement(rows, before, now).collect()}
    assert got == {5: (130000, 60000, 0), 4: (0, 0, 10000)}


def test_full_binary_tree_volume(spark, ws):
    edges = [(100, -1, 0)] + [(2 * i - 99 + k, i, k + 1) for i in range(100, 115) for k in (0, 1)]
    placement = spark.createDataFrame(edges, "user_id long, parent_id long, leg int")
    own = spark.createDataFrame([(u, 1000) for u in range(115, 131)], "user_id long, pv_own long")
    got = {r["user_id"]: (r["pv_1l"], r["pv_2l"]) for r in volume.leg_volume(ws, placement, own).collect()}
    assert got[100] == (8000, 8000) and got[103] == (2000, 2000) and got[114] == (1000, 1000)
    again = {r["user_id"]: (r["pv_1l"], r["pv_2l"]) for r in volume.leg_volume_by_closure(tree.closure(ws, placement, ("leg",)), own).collect()}
    assert again == got


def test_trees_fail_on_orphans_and_cycles(spark, ws):
    with pytest.raises(tree.TreeError):
        tree.depths(ws, spark.createDataFrame([(1, 7)], "user_id long, parent_id long"))
    with pytest.raises(tree.TreeError):
        tree.closure(ws, spark.createDataFrame([(1, 2), (2, 1)], "user_id long, parent_id long"), levels=8)


def test_nearest_and_children(spark, ws, sponsor):
    wanted = spark.createDataFrame([(3,), (5,)], "user_id long")
    got = {r["user_id"]: r["nearest"] for r in tree.nearest(ws, sponsor, wanted).collect()}
    assert (got[9], got[3], got[5], got[7]) == (3, 5, -1, -1)
    kids = tree.children(sponsor, spark.createDataFrame([(3,)], "user_id long")).first()
    assert kids["children"] == [1, 2]
    assert [r["user_id"] for r in tree.page(sponsor, "user_id", 3, 2).collect()] == [4, 5, 6]


def test_highest_honor(spark):
    members = spark.createDataFrame([(1, 0), (2, 70), (3, 80), (4, 60)], "user_id long, honor_before int")
    honors = spark.createDataFrame([(1, 90), (2, 80), (3, 90), (4, 50)], "user_id long, last int")
    history = spark.createDataFrame([(2, 9, 80), (3, 9, 90), (3, 8, 90), (4, 1, 90)], "user_id long, period int, honor int")
    got = {r["user_id"]: r["highest"] for r in honor.highest_honor(members, honors, history, 10).collect()}
    assert got == {1: 70, 2: 80, 3: 90, 4: 60}


@pytest.mark.parametrize("x, digits, expected", [("225.149", 2, "225.14"), ("-225.149", 2, "-225.14")])
def test_truncated(spark, x, digits, expected):
    assert str(spark.range(1).select(money.truncated(F.lit(x).cast("decimal(16,3)"), digits)).first()[0]) == expected


def test_money_functions(spark):
    row = spark.range(1).select(money.half_up(F.lit(12345), F.lit(50_000), 1_000_000), money.cut(F.lit(7), F.lit(1), F.lit(0)), money.unscaled_decimal(F.lit("/w=="), 2), money.previous_period(F.lit(202601), "yyyymm")).first()
    assert (row[0], row[1], str(row[2]), row[3]) == (617, None, "-0.01", 202512)


def test_config_fails_loudly():
    for rows in ([], [("eliteRate", "15"), ("eliteRate", "15")], [("eliteRate", "x")], [("eliteRate", "101")], [("eliteRate", None)]):
        with pytest.raises(ValueError):
            Config(rows).micro("eliteRate")
    assert Config([("eliteRate\n", "15")]).micro("eliteRate") == 150_000


def test_checks(spark, ws, sponsor):
    members = sponsor.select("user_id")
    placement = spark.createDataFrame([(1, -1, 0), (2, 1, 1), (3, 1, 1), (4, 1, 3)], "user_id long, parent_id long, leg int")
    orders = spark.createDataFrame([(99, None)], "user_id long, stockist_id long")
    report = checks.integrity_report(ws, members, sponsor, placement, orders)
    got = {r["name"]: r["violations"] for r in report.collect()}
    assert got["legs are 1 or 2"] == 1 and got["one child per leg"] == 1 and got["buyers are in the sponsor tree"] == 1
    assert checks.gate(report)[0] is False
    with pytest.raises(ValueError):
        checks.require_unique(spark.createDataFrame([(1, 2), (1, 3)], "k int, v int"), ["k"])
    with pytest.raises(ValueError):
        checks.require_amounts(spark.createDataFrame([("1.234",)], "a string"), "a")
    with pytest.raises(ValueError):
        checks.require_period(spark.createDataFrame([("x",)], "period string"), 3)


def test_members_off_the_tree_are_counted(spark, ws):
    """An orphan, what hangs on it, a detached cycle and what hangs on that; a second root counts as well."""
    edges = lambda rows: spark.createDataFrame(rows, "user_id long, parent_id long")
    chain = [(0, -1)] + [(i, i - 1) for i in range(1, 70)]
    assert checks.reachable(ws, edges(chain)).first()["unreached"] == 0
    got = checks.reachable(ws, edges([*chain, (100, 99), (101, 100), (200, 201), (201, 200), (202, 200), (300, -1)])).first()
    assert (got["members"], got["roots"], got["unreached"]) == (76, 2, 5)


def test_global_pool_halves_odd_rates_exactly(spark):
    layers = spark.createDataFrame([(1, 70, 1000, 70), (2, 70, 3000, 70), (3, 60, 9, 70)], "user_id long, layer int, lb_pv long, bonus int")
    members = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "user_id long, is_founder int")
    month = spark.createDataFrame([(1, 1_000_000_000, 1), (2, 0, 1)], "user_id long, pv_own long, is_active int")
    rates = spark.createDataFrame([(70, 333)], "layer int, rate long")
    got = {r["user_id"]: (r["bonus_head"], r["bonus_pv"]) for r in honor.global_pool(layers, members, month, rates).collect()}
    # 333 millionths of 10,000,000.00 are 3,330.00; half of it by heads, half by volume.
    assert got == {1: (83_250, 41_625), 2: (83_250, 124_875)}


def test_roots_may_be_spelled_zero(spark):
    edges = spark.createDataFrame([("1", "0"), ("2", "1"), ("3", None), ("4", "nan")], "user_id string, parent_id string")
    assert [r["user_id"] for r in tree.without_roots(edges, tree.ZERO).collect()] == ["2"]
    assert [r["parent_id"] for r in tree.rooted(edges, tree.ZERO).orderBy("user_id").collect()] == [-1, 1, -1, -1]
    assert tree.without_roots(edges).count() == 2


def test_descendants_to_a_depth_and_pages(spark, ws):
    edges = spark.createDataFrame(SPONSOR, "user_id long, parent_id long")
    start = spark.createDataFrame([(3,), (8,)], "user_id long")
    got = {tuple(r) for r in tree.descendants(ws, edges, start, deepest=2).collect()}
    assert got == {(3, 1, 1), (3, 2, 1), (3, 9, 2), (3, 13, 2), (3, 10, 2), (8, 7, 1)}
    rows = edges.where("parent_id <> -1")
    first = tree.page(rows, ("parent_id", "user_id"), None, 2).collect()
    assert [(r["parent_id"], r["user_id"]) for r in first] == [(1, 9), (1, 13), (2, 10)]
    assert [(r["parent_id"], r["user_id"]) for r in tree.page(rows, ("parent_id", "user_id"), (1, 13), 2).collect()] == [(2, 10), (3, 1), (3, 2)]


def test_a_closure_refuses_other_legs(spark, ws):
    with pytest.raises(tree.TreeError):
        tree.closure(ws, spark.createDataFrame([(1, -1, 0), (2, 1, 3)], "user_id long, parent_id long, leg int"), carry=("leg",))


def test_level_fees_round_by_order(spark, ws):
    sponsor = spark.createDataFrame([(1, -1), (2, 1), (3, 2)], "user_id long, parent_id long")
    orders = spark.createDataFrame([(1, 3, 5), (2, 3, 5), (3, 3, 15), (4, 2, 7)], "order_id long, user_id long, amount long")
    rates = spark.createDataFrame([(1, 100_000), (2, 100_000)], "level int, ppm long")
    got = {(r["user_id"], r["level"]): (r["commission"], r["n_orders"]) for r in bonuses.level_fee(ws, sponsor, orders, rates).collect()}
    assert got == {(2, 1): (1 + 1 + 2, 3), (1, 2): (1 + 1 + 2, 3), (1, 1): (1, 1)}
