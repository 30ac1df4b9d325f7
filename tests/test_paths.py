"""Folds by heavy paths against the fold by depth, over random and deep trees."""

import random

import pytest
from pyspark.sql import functions as F

from arborpay.operators import elite, paths, tree, volume

SCHEMA = "user_id long, parent_id long"


def forest(kind: str, n: int, seed: int) -> list[tuple[int, int]]:
    rng = random.Random(seed)
    parent = {
        "random": lambda i: rng.randrange(i),
        "chain": lambda i: i - 1,
        "star": lambda i: 0,
        "broom": lambda i: i - 1 if i < n // 2 else rng.randrange(n // 2 - 3, n // 2),
        "ragged": lambda i: max(0, i - rng.choice([1, 1, 1, 1, 7])),
        "roots": lambda i: tree.ROOT if i % 20 == 0 else rng.randrange(i),
    }[kind]
    edges = [(i, tree.ROOT if i == 0 else parent(i)) for i in range(n)]
    names = list(range(n))
    rng.shuffle(names)
    return [(names[i], tree.ROOT if p == tree.ROOT else names[p]) for i, p in edges]


def orders(n: int, seed: int) -> list[tuple]:
    rng = random.Random(seed)
    return [(u, u % 4, rng.choice([100, 4_000, 30_000, 99_999, 100_000, 250_000])) for u in range(n) for _ in range(rng.choice([0, 0, 0, 1, 2]))]


@pytest.mark.parametrize("kind", ["random", "broom", "roots"])
def test_decomposition(spark, ws, kind):
    rows = forest(kind, 150, 3)
    got = {r["user_id"]: r for r in paths.decompose(ws, spark.createDataFrame(rows, SCHEMA)).collect()}
    parent = dict(rows)
    size = dict.fromkeys(parent, 0)
    for u in parent:
        v = u
        while v != tree.ROOT:
            size[v] += 1
            v = parent[v]
    for u, p in rows:
        r = got[u]
        assert (r["parent_id"], r["depth"]) == (p, 0 if p == tree.ROOT else got[p]["depth"] + 1)
        assert r["level"] == size[r["path"]].bit_length() - 1
        if r["path"] == u:
            assert r["up"] == (-1 if p == tree.ROOT else got[p]["level"])
            assert p == tree.ROOT or r["up"] > r["level"]  # what hangs on a path is done before it
        else:
            assert r["path"] == got[p]["path"] and r["up"] == -1
    lowest = {}
    for u, p in rows:
        if p != tree.ROOT and got[u]["path"] != u:
            assert p not in lowest  # one child continues a path
            lowest[p] = u


def both(monkeypatch, run):
    """Sorted rows of a fold by depth and of one by heavy paths."""
    out = []
    for deep in (10**9, 0):
        monkeypatch.setattr(tree, "DEEP", deep)
        df = run()
        out.append((df.columns, sorted(map(str, df.collect()))))
    return out


@pytest.mark.parametrize("kind", ["random", "ragged"])
def test_rules_agree_with_the_fold_by_depth(spark, ws, monkeypatch, kind):
    n = 60
    sponsor = ws.table(spark.createDataFrame(forest(kind, n, 7), SCHEMA))
    bought = spark.createDataFrame(orders(n, 8), "user_id long, country_id int, pv long").withColumn("dec_type", F.lit("ZC"))
    own = ws.table(volume.own_volume(bought))
    team = ws.table(volume.team_volume(ws, sponsor, own))
    a, b = both(monkeypatch, lambda: elite.rank_snapshot(ws, sponsor, own))
    assert a == b
    a, b = both(monkeypatch, lambda: elite.elite_net(ws, team))
    assert a == b
    nets = []
    a, b = both(monkeypatch, lambda: nets.append(elite.level_net(ws, team)) or nets[-1])
    assert a == b
    a, b = both(monkeypatch, lambda: elite.elite_level(ws, nets[0]))
    assert a == b
    a, b = both(monkeypatch, lambda: volume.country_share(ws, sponsor, bought).select("user_id", "parent_id", F.col("country_id").cast("long").alias("country_id"), "pv", "n_orders", "n_users", "share_e4"))
    assert a == b
    members = sponsor.select("user_id", (F.col("user_id") % 3).alias("country_id"))
    net = elite.elite_net(ws, team)
    before = members.select("user_id", (F.col("user_id") * 977 % 70_000).alias("total_gpv"))
    a, b = both(monkeypatch, lambda: elite.performance_points(ws, members, sponsor, net, team.select("user_id", "pv_team"), before))
    assert a == b


def test_a_long_chain_takes_few_jobs(spark, ws):
    n = 20_000
    sponsor = ws.table(spark.range(n).select(F.col("id").alias("user_id"), (F.col("id") - 1).alias("parent_id")))
    own = ws.table(spark.range(n).select(F.col("id").alias("user_id"), F.lit(30_000).cast("long").alias("pv_own")))
    written = ws.count
    got = elite.rank_snapshot(ws, sponsor, own)
    assert ws.count - written < 100
    # From the lower end every fourth member reaches 120,000 and starts afresh.
    counts = {(r["gpv"], r["rank"]): r["n"] for r in got.groupBy("gpv", "rank").agg(F.count("*").alias("n")).collect()}
    assert sum(counts.values()) == n and {g for g, _ in counts} == {30_000, 60_000, 90_000, 120_000}
    assert sum(k for (g, _), k in counts.items() if g == 120_000) == n // 4


def test_cycles_and_orphans_are_errors(spark, ws):
    for rows in ([(1, 2), (2, 3), (3, 1), (4, -1)], [(1, -1), (2, 9)]):
        with pytest.raises(tree.TreeError):
            paths.decompose(ws, spark.createDataFrame(rows, SCHEMA))
