"""DuckDB SQL for the registered settlement queries, put together from named tables.

Each table states its part of the rules in SQL by itself. Threshold folds, which no single recursive
query can state, are unrolled by depth.
"""

from __future__ import annotations

import re

#: The quarter that is settled.
P = 7989
# The settlement configuration, rates in millionths, stated here again so that a wrong one in the engine shows.
_MICRO = {"eabRate": 100_000, "eliteRate": 150_000, "proEliteRate": 150_000, "stockistFeeRate": 80_000, "superEliteRate": 100_000, "teamBisectRate": 240_000}
_FAMILIES = {
    "leadershipRate": {10: 45_000, 20: 45_000, 30: 45_000, 40: 36_000, 50: 36_000, 60: 36_000, 70: 18_000, 80: 18_000, 90: 18_000},
    "leadershipLimit": {0: 0, 10: 0, 20: 30, 30: 60, 40: 90},
    "teamTouchRate": {10: 100_000, 20: 150_000, 30: 200_000, 40: 200_000},
    "teamTouchCapping": {10: 0, 20: 0, 30: 0, 40: 0},
    "carRate": {1: 8571, 2: 7143, 3: 5714, 4: 4286, 5: 2857, 6: 1429},
    "roomRate": {1: 5714, 2: 4762, 3: 3810, 4: 2857, 5: 1905, 6: 952},
    "globalPoolBonus": {70: 10_000, 80: 10_000, 90: 10_000},
    "globalPoolOpen": {10: 10_333, 20: 5001, 30: 20_000, 70: 10_000, 80: 10_000, 90: 10_000},
    "levelFee": {1: 100_000, 2: 50_000, 3: 30_000, 4: 20_000, 5: 10_000, 6: 5000},
}
#: Levels of unrolled folds: enough for three million members in the sponsor tree.
DEPTHS = range(13, -1, -1)


def _family(prefix: str) -> str:
    return f"(VALUES {', '.join(f'({k}, {v})' for k, v in _FAMILIES[prefix].items())})"


def _unrolled(name: str, nodes: str, given: str, taken: str, depth: str = "depth") -> dict[str, str]:
    """Tables <name>_<d>: rows of depth d from those of d + 1, and <name>, all of them."""
    out = {}
    for d in DEPTHS:
        below = f"{name}_{d + 1}" if d < DEPTHS[0] else None
        kids = f"SELECT parent_id AS pid, {given} FROM {below} GROUP BY parent_id" if below else f"SELECT parent_id AS pid, {given} FROM {name}_none GROUP BY parent_id"
        out[f"{name}_{d}"] = taken.format(src=f"(SELECT n.*, k.* EXCLUDE (pid) FROM {nodes} n LEFT JOIN ({kids}) k ON k.pid = n.user_id WHERE n.{depth} = {d})")
    out[name] = " UNION ALL ".join(f"SELECT * FROM {name}_{d}" for d in DEPTHS)
    return out


def _pools(family: str) -> str:
    return f"SELECT layer, CAST({_h('total')} * v // (n * 200) AS BIGINT) AS per_head, CAST({_h('total')} * v // (pv * 2) AS BIGINT) AS per_pv FROM (SELECT layer, sum(heads) AS n, sum(lb_pv * heads) AS pv FROM gp GROUP BY 1) JOIN {_family(family)} f(k, v) ON f.k = layer, (SELECT coalesce(sum(pv_own), 0) AS total FROM month)"


def _shares_of_pool(pool: str) -> str:
    return f"SELECT user_id, bonus_head, bonus_pv, bonus_head + bonus_pv AS bonus_gpb, coalesce(is_active, 0) AS is_active FROM (SELECT user_id, sum(CAST(CAST(per_head AS HUGEINT) * heads // 10000 AS BIGINT)) AS bonus_head, sum(CAST(CAST(lb_pv * heads AS HUGEINT) * per_pv // 1000000 AS BIGINT)) AS bonus_pv FROM gp JOIN {pool} USING (layer) WHERE bonus >= layer GROUP BY 1) LEFT JOIN month USING (user_id)"


T: dict[str, str] = {
    "members": "SELECT c_custkey AS user_id, c_nationkey AS country_id, (c_custkey % 4 + 1) * 10 AS member_level, CAST(c_custkey % 17 = 0 AS INT) AS is_founder, c_acctbal > 9000 AS listed, (c_custkey % 7) * 10 AS honor_before FROM customer",
    "regions": "SELECT n_nationkey AS country_id, n_regionkey AS region_id FROM nation",
    "sponsor": "SELECT c_custkey AS user_id, CASE WHEN c_custkey = 0 THEN -1 ELSE (c_custkey - 1) // 3 END AS parent_id FROM customer",
    "placement": "SELECT c_custkey AS user_id, CASE WHEN c_custkey = 0 THEN -1 ELSE (c_custkey - 1) // 2 END AS parent_id, CAST(CASE WHEN c_custkey = 0 THEN 0 ELSE (c_custkey - 1) % 2 + 1 END AS INT) AS leg FROM customer",
    "all_orders": """SELECT o_orderkey AS order_id, CAST(year(o_orderdate) * 4 + quarter(o_orderdate) AS INT) AS period, o_custkey AS user_id,
        (CAST(round(o_totalprice * 100) AS BIGINT) * 5 + 500) // 1000 AS pv, CAST(round(o_totalprice * 100) AS BIGINT) AS amount,
        CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'ZC' ELSE 'FX' END AS dec_type, o_orderkey % 3 + 1 AS type_id,
        CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey // 7 END AS stockist_id, country_id
        FROM orders LEFT JOIN members ON user_id = o_custkey""",
    "ord": f"SELECT * FROM all_orders WHERE period = {P}",
    "past": f"SELECT user_id, CAST(sum(pv) AS BIGINT) AS pv FROM all_orders WHERE period = {P - 1} GROUP BY 1",
    "own": "SELECT user_id, CAST(sum(pv) AS BIGINT) AS pv_own, CAST(coalesce(sum(pv) FILTER (dec_type = 'ZC'), 0) AS BIGINT) AS pv_zc, CAST(coalesce(sum(pv) FILTER (dec_type = 'FX'), 0) AS BIGINT) AS pv_fx FROM ord GROUP BY 1",
    "sdepth": "SELECT user_id, parent_id, 0 AS depth FROM sponsor WHERE parent_id = -1 UNION ALL SELECT s.user_id, s.parent_id, d.depth + 1 FROM sponsor s JOIN sdepth d ON s.parent_id = d.user_id",
    "pdepth": "SELECT user_id, parent_id, 0 AS depth FROM placement WHERE parent_id = -1 UNION ALL SELECT s.user_id, s.parent_id, d.depth + 1 FROM placement s JOIN pdepth d ON s.parent_id = d.user_id",
    "sup": "SELECT user_id AS descendant, parent_id AS ancestor, 1 AS level FROM sponsor WHERE parent_id <> -1 UNION ALL SELECT u.descendant, s.parent_id, u.level + 1 FROM sup u JOIN sponsor s ON s.user_id = u.ancestor WHERE s.parent_id <> -1",
    "pup": "SELECT user_id AS descendant, parent_id AS ancestor, 1 AS level, leg FROM placement WHERE parent_id <> -1 UNION ALL SELECT u.descendant, s.parent_id, u.level + 1, s.leg FROM pup u JOIN placement s ON s.user_id = u.ancestor WHERE s.parent_id <> -1",
    "pss": "SELECT user_id, CAST(sum(pv_own) AS BIGINT) AS pv_team, CAST(sum(below) AS BIGINT) AS below FROM (SELECT user_id, pv_own, 0 AS below FROM own UNION ALL SELECT ancestor, pv_own, 1 FROM sup JOIN own ON user_id = descendant) GROUP BY 1",
    "team": "SELECT d.user_id, d.parent_id, d.depth, coalesce(pv_own, 0) AS pv_own, pv_team, below FROM pss JOIN sdepth d USING (user_id) LEFT JOIN own USING (user_id)",
    "legs": "SELECT ancestor AS user_id, CAST(coalesce(sum(pv_own) FILTER (leg = 1), 0) AS BIGINT) AS pv_1l, CAST(coalesce(sum(pv_own) FILTER (leg = 2), 0) AS BIGINT) AS pv_2l FROM pup JOIN own ON user_id = descendant GROUP BY 1",
    "past_legs": "SELECT ancestor AS user_id, coalesce(sum(pv) FILTER (leg = 1), 0) AS a, coalesce(sum(pv) FILTER (leg = 2), 0) AS b FROM pup JOIN past ON user_id = descendant GROUP BY 1",
    "carry": "SELECT user_id, CAST(greatest(a - b, 0) AS BIGINT) AS surplus_1l, CAST(greatest(b - a, 0) AS BIGINT) AS surplus_2l FROM past_legs",
    "stock": "SELECT stockist_id AS user_id, CAST(sum(pv) AS BIGINT) AS stockist_pv FROM ord WHERE stockist_id IS NOT NULL GROUP BY 1",
    "month": f"""SELECT u.user_id, coalesce(pv_own, 0) AS pv_own, coalesce(pv_zc, 0) AS pv_zc, coalesce(pv_fx, 0) AS pv_fx, coalesce(pv_team, 0) AS pv_team,
        coalesce(pv_1l, 0) AS pv_1l, coalesce(pv_2l, 0) AS pv_2l, coalesce(surplus_1l, 0) AS pre_surplus_1l, coalesce(surplus_2l, 0) AS pre_surplus_2l,
        coalesce(pv_1l, 0) + coalesce(surplus_1l, 0) AS total_1l, coalesce(pv_2l, 0) + coalesce(surplus_2l, 0) AS total_2l, coalesce(stockist_pv, 0) AS stockist_pv,
        CAST(coalesce(pv_own, 0) >= 3000 OR coalesce(listed, false) AS INT) AS is_active, coalesce(country_id, -1) AS country_id
        FROM (SELECT user_id FROM own UNION SELECT user_id FROM pss UNION SELECT user_id FROM legs UNION SELECT user_id FROM stock) u
        LEFT JOIN own USING (user_id) LEFT JOIN pss USING (user_id) LEFT JOIN legs USING (user_id) LEFT JOIN stock USING (user_id) LEFT JOIN carry USING (user_id) LEFT JOIN members USING (user_id)""",
    "enet_none": "SELECT 0 AS parent_id, CAST(NULL AS INT) AS elite, CAST(0 AS BIGINT) AS gpv WHERE false",
    **_unrolled("enet", "team", "CAST(sum(gpv) FILTER (elite = 0) AS BIGINT) AS s, max(elite) AS q", """SELECT user_id, parent_id, depth, pv_own, pv_own + coalesce(s, 0) AS gpv,
        CASE WHEN pv_own + coalesce(s, 0) >= 100000 OR coalesce(q, 0) = 10 THEN 10 ELSE 0 END AS elite,
        CASE WHEN pv_own + coalesce(s, 0) >= 100000 OR coalesce(q, 0) = 10 THEN pv_own + coalesce(s, 0) ELSE 0 END AS gpv_real FROM {src}"""),
    "lnet_none": "SELECT 0 AS parent_id, CAST(0 AS BIGINT) AS gpv, CAST(0 AS BIGINT) AS rl, CAST(0 AS BIGINT) AS passes WHERE false",
    **_unrolled("lnet", "team", "CAST(sum(gpv) FILTER (rl = 0) AS BIGINT) AS s, CAST(sum(passes) AS BIGINT) AS h", """SELECT user_id, parent_id, depth, pv_own, pv_own + coalesce(s, 0) AS gpv,
        CASE WHEN pv_own + coalesce(s, 0) >= 100000 THEN pv_own + coalesce(s, 0) ELSE 0 END AS rl, coalesce(h, 0) AS hang,
        pv_own + coalesce(s, 0) >= 100000 OR coalesce(h, 0) >= 2 AS kept,
        CASE WHEN pv_own + coalesce(s, 0) >= 100000 OR coalesce(h, 0) >= 2 THEN 1 ELSE coalesce(h, 0) END AS passes FROM {src}"""),
    "kept_up": "SELECT descendant AS user_id, min_by(ancestor, level) AS parent_id FROM sup JOIN lnet k ON k.user_id = ancestor AND k.kept GROUP BY 1",
    "cnet": "SELECT n.user_id, coalesce(u.parent_id, -1) AS parent_id, rl AS gpv, CASE WHEN rl >= 200000 THEN 100000 ELSE rl END AS own_real, CASE WHEN rl >= 200000 THEN rl - 100000 ELSE 0 END AS gpv_unreal, hang + CASE WHEN rl >= 200000 THEN rl // 100000 ELSE 0 END AS sons FROM lnet n LEFT JOIN kept_up u USING (user_id) WHERE kept",
    "cdepth": "SELECT *, 0 AS top_deep FROM cnet WHERE parent_id = -1 UNION ALL SELECT c.*, d.top_deep + 1 FROM cnet c JOIN cdepth d ON c.parent_id = d.user_id",
    "push_none": "SELECT 0 AS parent_id, CAST(0 AS BIGINT) AS val, CAST(0 AS BIGINT) AS user_id WHERE false",
    **_unrolled("push", "cdepth", "arg_min(struct_pack(val, user_id), struct_pack(a := val, b := -user_id)) AS least", """SELECT user_id, parent_id, top_deep, gpv, own_real, gpv_unreal, sons,
        CASE WHEN own_real = 0 AND sons >= 2 AND least IS NOT NULL THEN least.val ELSE own_real END AS val, CASE WHEN own_real = 0 AND sons >= 2 THEN least.user_id END AS pulled FROM {src}""", depth="top_deep"),
    "levels": "SELECT user_id, parent_id, top_deep, gpv, CASE WHEN user_id IN (SELECT pulled FROM push WHERE pulled IS NOT NULL) THEN 0 ELSE val END AS gpv_real, gpv_unreal, sons, CASE WHEN sons > 2 THEN 30 WHEN sons = 0 THEN 10 ELSE 20 END AS elite_level FROM push",
    "rank_none": "SELECT 0 AS parent_id, CAST(0 AS BIGINT) AS contrib, 0 AS rank, CAST(0 AS BIGINT) AS legs WHERE false",
    "rnodes": "SELECT d.*, coalesce(pv_own, 0) AS pv_own FROM sdepth d LEFT JOIN own USING (user_id)",
    "pnodes": "SELECT d.*, coalesce(pv, 0) AS pv_own FROM sdepth d LEFT JOIN past USING (user_id)",
    "prev_none": "SELECT 0 AS parent_id, CAST(0 AS BIGINT) AS contrib, 0 AS rank, CAST(0 AS BIGINT) AS legs WHERE false",
}
_RANK = """SELECT *, CASE WHEN legs + virtual_width >= 3 THEN 30 WHEN (is_elite AND legs + virtual_width >= 1) OR (NOT is_elite AND legs + virtual_width >= 2) THEN 20 WHEN is_elite THEN 10 ELSE 0 END AS rank
    FROM (SELECT user_id, parent_id, depth, pv_own, pv_own + coalesce(s, 0) AS gpv, coalesce(l, 0) AS legs, pv_own + coalesce(s, 0) >= 100000 AS is_elite,
    CASE WHEN pv_own + coalesce(s, 0) >= 100000 THEN 0 ELSE pv_own + coalesce(s, 0) END AS contrib,
    CASE WHEN pv_own + coalesce(s, 0) >= 200000 THEN (pv_own + coalesce(s, 0)) // 100000 ELSE 0 END AS virtual_width FROM {src})"""
_GIVEN = "CAST(sum(contrib) AS BIGINT) AS s, count(*) FILTER (rank >= 10 OR legs >= 1) AS l"


def _folded(name: str, nodes: str, given: str, none: str, taken: str) -> dict[str, str]:
    """Table <name>: a fold of any depth, a round for each, over the rows of the round before."""
    deepest = f"(SELECT n.*, {none} FROM {nodes} n WHERE depth = (SELECT max(depth) FROM {nodes}))"
    next_up = f"(SELECT n.*, k.* EXCLUDE (pid) FROM {nodes} n LEFT JOIN (SELECT parent_id AS pid, {given} FROM {name} GROUP BY parent_id) k ON k.pid = n.user_id WHERE n.depth = (SELECT min(depth) FROM {name}) - 1)"
    return {name: f"{taken.format(src=deepest)} UNION ALL {taken.format(src=next_up)}"}


T |= {
    "ragged": "SELECT c_custkey AS user_id, CASE WHEN c_custkey = 0 THEN -1 WHEN c_custkey % 5 = 1 THEN greatest(c_custkey - 5, 0) WHEN c_custkey % 5 = 2 THEN 0 WHEN c_custkey % 5 = 3 THEN c_custkey // 7 WHEN c_custkey % 5 = 4 THEN c_custkey - 1 ELSE (c_custkey - 1) // 3 END AS parent_id FROM customer",
    "gdepth": "SELECT user_id, parent_id, 0 AS depth FROM ragged WHERE parent_id = -1 UNION ALL SELECT s.user_id, s.parent_id, d.depth + 1 FROM ragged s JOIN gdepth d ON s.parent_id = d.user_id",
    "gup": "SELECT user_id AS descendant, user_id AS ancestor FROM ragged UNION ALL SELECT u.descendant, s.parent_id FROM gup u JOIN ragged s ON s.user_id = u.ancestor WHERE s.parent_id <> -1",
    "gnodes": "SELECT d.*, coalesce(pv_own, 0) AS pv_own FROM gdepth d LEFT JOIN own USING (user_id)",
    "gteam": "SELECT * FROM gnodes WHERE user_id IN (SELECT ancestor FROM gup JOIN own ON own.user_id = descendant)",
    **_folded("grank", "gnodes", _GIVEN, "CAST(NULL AS BIGINT) AS s, CAST(NULL AS BIGINT) AS l", _RANK),
    **_folded("gnet", "gteam", "CAST(sum(gpv) FILTER (elite = 0) AS BIGINT) AS s, max(elite) AS q", "CAST(NULL AS BIGINT) AS s, CAST(NULL AS INT) AS q", """SELECT user_id, parent_id, depth, pv_own, pv_own + coalesce(s, 0) AS gpv,
        CASE WHEN pv_own + coalesce(s, 0) >= 100000 OR coalesce(q, 0) = 10 THEN 10 ELSE 0 END AS elite,
        CASE WHEN pv_own + coalesce(s, 0) >= 100000 OR coalesce(q, 0) = 10 THEN pv_own + coalesce(s, 0) ELSE 0 END AS gpv_real FROM {src}"""),
    "gshares": "SELECT ancestor AS user_id, coalesce(country_id, 1) AS country_id, CAST(sum(pv) AS BIGINT) AS pv, count(*) AS n_orders, count(DISTINCT descendant) AS n_users FROM gup JOIN ord ON ord.user_id = descendant GROUP BY ALL",
}
T |= _unrolled("rank", "rnodes", _GIVEN, _RANK) | _unrolled("prev", "pnodes", _GIVEN, _RANK)


def _wide(expr: str, by: str) -> str:
    return f"CAST(({expr}) // ({by}) AS BIGINT)"


def _h(x: str) -> str:
    return f"CAST({x} AS HUGEINT)"


T |= {
    "cup": "SELECT user_id AS descendant, parent_id AS ancestor, 1 AS level FROM levels WHERE parent_id <> -1 UNION ALL SELECT u.descendant, l.parent_id, u.level + 1 FROM cup u JOIN levels l ON l.user_id = u.ancestor WHERE l.parent_id <> -1",
    "se_up": "SELECT l.user_id, coalesce(min_by(ancestor, level) FILTER (s.user_id IS NOT NULL), -1) AS se FROM levels l LEFT JOIN cup ON descendant = l.user_id LEFT JOIN levels s ON s.user_id = ancestor AND s.elite_level = 30 GROUP BY 1",
    "srcs": """SELECT * FROM (SELECT CASE WHEN e.se = l.parent_id THEN g.se ELSE e.se END AS user_id, l.user_id AS source_id, gpv_real AS pv FROM levels l JOIN se_up e USING (user_id) LEFT JOIN se_up g ON g.user_id = l.parent_id WHERE top_deep > 0
        UNION ALL SELECT e.se, l.user_id, gpv_unreal FROM levels l JOIN se_up e USING (user_id) WHERE top_deep > 0 AND gpv_unreal > 0) WHERE user_id <> -1""",
    "act": "SELECT user_id, sum(pv) AS lb_pv FROM srcs WHERE user_id IN (SELECT user_id FROM levels) GROUP BY 1 HAVING sum(pv) > 0",
    "walk": "SELECT a.user_id, e.se, 10 AS layer, lb_pv FROM act a JOIN se_up e USING (user_id) UNION ALL SELECT w.se, e.se, w.layer + 10, w.lb_pv FROM walk w JOIN act a ON a.user_id = w.se JOIN se_up e ON e.user_id = w.se",
    "chain": "SELECT l.user_id, e.se, 1 AS n FROM levels l JOIN se_up e USING (user_id) WHERE elite_level = 30 UNION ALL SELECT c.se, e.se, c.n + 1 FROM chain c JOIN act a ON a.user_id = c.se JOIN se_up e ON e.user_id = c.se",
    "chains": "SELECT user_id, se, max(n) AS n FROM chain GROUP BY ALL",
    "hbase": """SELECT w.user_id, w.legs_max, coalesce(l90, 0) AS legs_90, coalesce(l80, 0) AS legs_80, coalesce(l70, 0) AS legs_70, greatest(coalesce(c.n, 0) - 1, 0) AS chain
        FROM (SELECT user_id, max(layer) AS legs_max FROM walk GROUP BY 1) w
        LEFT JOIN (SELECT se AS user_id, count(*) FILTER (n >= 3) AS l90, count(*) FILTER (n >= 2) AS l80, count(*) FILTER (n >= 1) AS l70 FROM chains GROUP BY 1) USING (user_id)
        LEFT JOIN (SELECT user_id, max(n) AS n FROM chains GROUP BY 1) c USING (user_id)""",
    "hori": "SELECT *, CASE WHEN legs_max >= 90 AND legs_90 >= 3 THEN 90 WHEN legs_max >= 80 AND legs_80 >= 3 THEN 80 WHEN legs_max >= 70 AND legs_70 >= 3 THEN 70 ELSE least(legs_max, 60) END AS ori FROM hbase",
    "honors": f"SELECT *, least(bonus, chain * 10) AS last FROM (SELECT h.*, lim.v AS honor_limit, CASE WHEN ori <= lim.v THEN ori ELSE lim.v END AS bonus FROM hori h LEFT JOIN members m USING (user_id) LEFT JOIN {_family('leadershipLimit')} lim(k, v) ON lim.k = m.member_level)",
    "hlayers": "SELECT user_id, layer, CAST(sum(lb_pv) AS BIGINT) AS lb_pv, any_value(bonus) AS bonus FROM walk JOIN honors USING (user_id) WHERE layer <= ori GROUP BY user_id, layer",
    "history": f"SELECT user_id, period, least(90, CAST(sum(pv) AS BIGINT) // 10000 * 10) AS honor FROM all_orders WHERE period BETWEEN {P - 15} AND {P - 1} GROUP BY user_id, period",
    "hcounts": f"SELECT user_id, count(*) FILTER (honor >= 80) AS n80, count(*) FILTER (honor = 90) AS n90 FROM (SELECT user_id, honor FROM history WHERE period BETWEEN {P - 11} AND {P - 1} AND honor >= 80 UNION ALL SELECT user_id, last FROM honors) GROUP BY 1",
    "hhigh": """SELECT user_id, before, last, CASE WHEN two < 90 AND n90 >= 3 THEN 90 ELSE two END AS highest FROM (
        SELECT *, CASE WHEN one < 80 AND n80 >= 2 THEN 80 ELSE one END AS two FROM (
        SELECT user_id, honor_before AS before, coalesce(last, 0) AS last, n80, n90, CASE WHEN honor_before < 70 AND honor_before < last THEN least(last, 70) ELSE honor_before END AS one
        FROM members LEFT JOIN honors USING (user_id) LEFT JOIN hcounts USING (user_id)))""",
    "lbseed": "SELECT s.user_id, m.country_id, sum(pv) AS lb_pv FROM srcs s LEFT JOIN members m ON m.user_id = source_id WHERE s.user_id IN (SELECT user_id FROM levels) GROUP BY ALL HAVING sum(pv) > 0",
    "lbwalk": "SELECT a.user_id, e.se, 10 AS layer, a.country_id, a.lb_pv FROM lbseed a JOIN se_up e USING (user_id) UNION ALL SELECT w.se, e.se, w.layer + 10, w.country_id, w.lb_pv FROM lbwalk w JOIN act a ON a.user_id = w.se JOIN se_up e ON e.user_id = w.se",
    "lblayers": "SELECT w.*, coalesce(region_id, w.country_id) AS region_id FROM (SELECT user_id, country_id, layer, sum(lb_pv) AS lb_pv, any_value(bonus) AS bonus FROM lbwalk JOIN honors USING (user_id) WHERE layer <= ori GROUP BY user_id, country_id, layer) w LEFT JOIN regions r ON r.country_id = w.country_id",
    "regpv": "SELECT coalesce(region_id, m.country_id) AS region_id, sum(pv_own) AS pv FROM month m LEFT JOIN regions r ON r.country_id = m.country_id GROUP BY 1",
    "lbpool": f"SELECT *, CAST({_h('pool')} * 100 // {_h('layer_pv')} AS BIGINT) AS lb_rate FROM (SELECT l.region_id, l.layer, l.layer_pv, CAST({_h('coalesce(pv, 0)')} * coalesce(f.v, 0) // 100 AS BIGINT) AS pool FROM (SELECT region_id, layer, sum(lb_pv) AS layer_pv FROM lblayers GROUP BY ALL HAVING sum(lb_pv) > 0) l LEFT JOIN regpv USING (region_id) LEFT JOIN {_family('leadershipRate')} f(k, v) ON f.k = l.layer)",
    "lbdet": f"""SELECT d.user_id, d.layer, d.region_id, d.lb_pv, d.bonus_level, d.layer_pv, d.lb_rate, d.bonus_lb, CASE WHEN d.region_id = coalesce(r.region_id, m.country_id) THEN m.country_id ELSE d.region_id END AS country_id FROM (
        SELECT l.user_id, l.layer, l.region_id, sum(l.lb_pv) AS lb_pv, max(l.bonus) AS bonus_level, max(p.layer_pv) AS layer_pv, max(p.lb_rate) AS lb_rate, sum({_wide(_h('l.lb_pv') + ' * coalesce(p.lb_rate, 0)', '1000000')}) AS bonus_lb
        FROM lblayers l LEFT JOIN lbpool p ON p.region_id = l.region_id AND p.layer = l.layer GROUP BY l.user_id, l.layer, l.region_id) d LEFT JOIN members m ON m.user_id = d.user_id LEFT JOIN regions r ON r.country_id = m.country_id""",
    "b_lb": "SELECT * FROM (SELECT user_id, country_id, sum(bonus_lb) AS ori_bonus_lb, coalesce(sum(bonus_lb) FILTER (layer <= bonus_level), 0) AS bonus_lb FROM lbdet GROUP BY ALL) WHERE bonus_lb > 0",
    "b_e": f"SELECT user_id, parent_id, depth AS top_deep, gpv_real, {_wide(_h('gpv_real') + f' * {_MICRO["eliteRate"]}', '1000000')} AS bonus_e FROM enet WHERE gpv_real > 0 AND elite = 10",
    "b_pe": f"SELECT *, {_wide(_h('base') + f' * {_MICRO["proEliteRate"]}', '1000000')} AS bonus_pe FROM (SELECT l.user_id, coalesce(kids, 0) + gpv_unreal AS base, coalesce(is_active, 0) AS is_active FROM levels l LEFT JOIN (SELECT parent_id AS user_id, sum(gpv_real) AS kids FROM levels GROUP BY 1) USING (user_id) LEFT JOIN month USING (user_id) WHERE elite_level >= 20)",
    "ordreg": "SELECT coalesce(region_id, o.country_id) AS region_id, sum(pv) AS pv FROM ord o LEFT JOIN regions r ON r.country_id = o.country_id GROUP BY 1",
    "b_se": f"""SELECT s.*, b.bonus_se, coalesce(is_active, 0) AS is_active FROM (SELECT l.user_id, m.country_id, coalesce(region_id, m.country_id) AS region_id FROM levels l JOIN members m USING (user_id) LEFT JOIN regions r ON r.country_id = m.country_id WHERE elite_level = 30) s
        JOIN (SELECT region_id, CAST({_h('pv')} * {_MICRO['superEliteRate']} // (n * 1000000) AS BIGINT) AS bonus_se FROM (SELECT coalesce(region_id, m.country_id) AS region_id, count(*) AS n FROM levels l JOIN members m USING (user_id) LEFT JOIN regions r ON r.country_id = m.country_id WHERE elite_level = 30 GROUP BY 1) JOIN ordreg USING (region_id)) b USING (region_id)
        LEFT JOIN month mo USING (user_id) WHERE bonus_se > 0""",
    "tmatch": f"""SELECT *, CASE WHEN cap = 0 OR cap > ori_base THEN ori_base ELSE cap END AS base FROM (SELECT t.*, CAST({_h('touch_pv')} * rate // 10000 AS BIGINT) AS ori_base FROM (
        SELECT mo.user_id, mo.country_id, is_active, pv_own, total_1l, total_2l, total_1l - least(total_1l, total_2l) AS surplus_1l, total_2l - least(total_1l, total_2l) AS surplus_2l, least(total_1l, total_2l) AS touch_pv, coalesce(r.v, 0) AS rate, coalesce(c.v, 0) * 10000 AS cap
        FROM month mo LEFT JOIN members m USING (user_id) LEFT JOIN {_family('teamTouchRate')} r(k, v) ON r.k = member_level LEFT JOIN {_family('teamTouchCapping')} c(k, v) ON c.k = member_level) t)""",
    "b_tb": f"""SELECT t.user_id, t.country_id, touch_pv, surplus_1l, surplus_2l, ori_base, base, tb_rate, CAST({_h('base')} * tb_rate // 100000000 AS BIGINT) AS bonus_tb FROM tmatch t,
        (SELECT coalesce(CAST({_h('(SELECT sum(pv_own) FROM tmatch)')} * {_MICRO['teamBisectRate'] * 100} // nullif((SELECT sum(base) FROM tmatch WHERE is_active = 1 AND touch_pv > 0), 0) AS BIGINT), 0) AS tb_rate)
        WHERE touch_pv > 0 AND base > 0 AND is_active = 1 AND tb_rate > 0""",
    "b_sfb": f"""SELECT * FROM (SELECT *, bonus_unity + bonus_app + bonus_otc AS bonus_sfb FROM (SELECT s.*, {', '.join(_wide(_h(f'pv_{n}') + f' * {_MICRO["stockistFeeRate"]}', '1000000') + f' AS bonus_{n}' for n in ('unity', 'app', 'otc'))}, m.country_id FROM (
        SELECT stockist_id AS user_id, sum(pv) AS stockist_pv, {', '.join(f'coalesce(sum(pv) FILTER (type_id = {k}), 0) AS pv_{n}' for k, n in ((1, 'unity'), (2, 'app'), (3, 'otc')))} FROM ord WHERE stockist_id IS NOT NULL GROUP BY 1) s LEFT JOIN members m USING (user_id) WHERE stockist_pv > 0)) WHERE bonus_sfb > 0""",
    "gp": "SELECT h.*, 1 + is_founder AS heads FROM hlayers h JOIN members USING (user_id)",
    "gpool": _pools("globalPoolBonus"),
    "gpopen": _pools("globalPoolOpen"),
    "b_gpb": _shares_of_pool("gpool"),
    "b_gpo": _shares_of_pool("gpopen"),
    "enrolled": f"SELECT c_custkey AS user_id, 'CAR' AS kind, c_custkey % 3 + {P - 1} AS end_period, 50000 AS capping FROM customer WHERE c_custkey % 20 = 0 UNION ALL SELECT c_custkey, 'ROOM', c_custkey % 3 + {P - 1}, 30000 FROM customer WHERE c_custkey % 25 = 0",
    "crb": "SELECT user_id AS bonus_id, user_id, gpv AS gpv_real, 1 AS layer, 1 AS deep FROM lnet WHERE user_id IN (SELECT user_id FROM enrolled) UNION ALL SELECT c.bonus_id, n.user_id, n.rl, CASE WHEN n.rl > 0 THEN c.deep + 1 ELSE 0 END, CASE WHEN n.rl > 0 THEN c.deep + 1 ELSE c.deep END FROM crb c JOIN lnet n ON n.parent_id = c.user_id",
    "crbpool": "SELECT coalesce(sum(pv), 0) AS pool FROM ord WHERE country_id IN (1, 3, 4)",
}
for _kind, _prefix in (("CAR", "carRate"), ("ROOM", "roomRate")):
    _k = _kind.lower()
    T |= {
        f"m_{_k}": f"SELECT bonus_id AS user_id, gpv_real, layer, end_period, capping FROM crb JOIN enrolled e ON e.user_id = bonus_id AND kind = '{_kind}' WHERE layer BETWEEN 1 AND 6",
        f"s_{_k}": f"SELECT layer, coalesce(CAST(({_h('pool')} * v // 200) * 100 // nullif(total, 0) AS BIGINT), 0) AS share FROM (SELECT layer, sum(gpv_real) AS total FROM m_{_k} GROUP BY 1) JOIN {_family(_prefix)} f(k, v) ON f.k = layer, crbpool",
        f"p_{_k}": f"SELECT user_id, ori, CASE WHEN end_period < {P} THEN 0 ELSE least(ori, capping) END AS paid FROM (SELECT user_id, end_period, capping, sum(CAST({_h('gpv_real')} * share // 1000000 AS BIGINT)) AS ori FROM m_{_k} JOIN s_{_k} USING (layer) GROUP BY ALL)",
    }
T |= {
    "b_crb": "SELECT * FROM (SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.ori, 0) AS ori_car, coalesce(a.paid, 0) AS bonus_car, coalesce(b.ori, 0) AS ori_room, coalesce(b.paid, 0) AS bonus_room, coalesce(is_active, 0) AS is_active, coalesce(a.paid, 0) + coalesce(b.paid, 0) AS bonus_crb FROM p_car a FULL JOIN p_room b ON a.user_id = b.user_id LEFT JOIN month mo ON mo.user_id = coalesce(a.user_id, b.user_id)) WHERE bonus_crb > 0",
    "eabwho": "SELECT e.user_id, gpv, m.country_id, coalesce(region_id, m.country_id) AS region_id FROM enet e JOIN members m USING (user_id) LEFT JOIN regions r ON r.country_id = m.country_id WHERE gpv >= 100000",
    "b_eab": f"SELECT w.user_id, gpv, country_id, region_id, bonus_eab, CASE WHEN coalesce(is_active, 0) = 1 THEN bonus_eab ELSE 0 END AS payable, coalesce(is_active, 0) AS is_active FROM eabwho w JOIN (SELECT region_id, coalesce(CAST(({_h('pv')} * {2 * _MICRO['eabRate']} + n * 1000000) // (n * 2000000) AS BIGINT), 0) AS bonus_eab FROM (SELECT region_id, count(*) AS n FROM eabwho GROUP BY 1) LEFT JOIN ordreg USING (region_id)) USING (region_id) LEFT JOIN (SELECT user_id, is_active FROM month) USING (user_id) WHERE bonus_eab > 0",
    "pbnodes": """SELECT d.user_id, d.parent_id, d.depth, m.country_id, coalesce(e.gpv, 0) AS gpv, coalesce(e.pv_own, 0) AS pv, coalesce(e.elite, 0) AS elite, coalesce(p.pv, 0) + coalesce(e.gpv, 0) AS total_gpv,
        greatest(CASE WHEN coalesce(p.pv, 0) >= 60000 THEN 30 WHEN coalesce(p.pv, 0) >= 30000 THEN 20 ELSE 10 END, CASE WHEN coalesce(mo.pv_team, 0) >= 60000 THEN 30 ELSE 10 END,
        CASE WHEN coalesce(p.pv, 0) + coalesce(e.gpv, 0) >= 60000 THEN 30 WHEN coalesce(p.pv, 0) + coalesce(e.gpv, 0) >= 30000 THEN 20 ELSE 10 END) AS level
        FROM sdepth d JOIN members m USING (user_id) LEFT JOIN enet e USING (user_id) LEFT JOIN month mo USING (user_id) LEFT JOIN past p USING (user_id)""",
    "pb_none": "SELECT 0 AS parent_id, 0 AS elite, CAST(0 AS BIGINT) AS bonus_20, CAST(0 AS BIGINT) AS bonus_30 WHERE false",
    **_unrolled("pb", "pbnodes", "CAST(sum(bonus_20) FILTER (elite = 0) AS BIGINT) AS s20, CAST(sum(bonus_30) FILTER (elite = 0) AS BIGINT) AS s30", """SELECT user_id, parent_id, depth, country_id, gpv, elite, total_gpv, level,
        CASE WHEN gpv >= 100000 THEN 0 ELSE pv * (level + 10) // 100 + CASE WHEN level >= 20 THEN coalesce(s20, 0) ELSE 0 END + CASE WHEN level >= 30 THEN coalesce(s30, 0) ELSE 0 END END AS points,
        CASE WHEN gpv >= 100000 OR level >= 20 THEN 0 ELSE pv // 10 + coalesce(s20, 0) END AS bonus_20, CASE WHEN gpv >= 100000 OR level >= 30 THEN 0 ELSE pv // 10 + coalesce(s30, 0) END AS bonus_30 FROM {src}"""),
    "b_pb": "SELECT user_id, country_id, level, total_gpv, points AS bonus_pb, gpv AS pb_pv FROM pb WHERE points > 0",
}
_NAMES = {"e": False, "pe": True, "se": True, "lb": True, "tb": True, "sfb": False, "gpb": True, "crb": True, "eab": True}
_SUMS = " ".join(f"LEFT JOIN (SELECT user_id, sum(bonus_{n}) AS x_{n} FROM b_{n} GROUP BY 1) USING (user_id)" for n in _NAMES)
T |= {
    "tot": f"""SELECT *, {' + '.join(f'bonus_{n}' for n in _NAMES)} AS total_bonus FROM (SELECT u.user_id, m.country_id, coalesce(mo.is_active, 0) AS is_active, coalesce(bonus_pb, 0) AS total_points,
        {', '.join(f"CASE WHEN {'coalesce(mo.is_active, 0) = 1' if a else 'true'} THEN coalesce(x_{n}, 0) ELSE 0 END AS bonus_{n}" for n, a in _NAMES.items())}
        FROM ({' UNION '.join(f'SELECT user_id FROM b_{n}' for n in (*_NAMES, 'pb'))}) u LEFT JOIN month mo USING (user_id) LEFT JOIN members m USING (user_id) {_SUMS} LEFT JOIN (SELECT user_id, bonus_pb FROM b_pb) USING (user_id))""",
    "idle": f"""SELECT u.user_id, m.country_id, coalesce(pv_own, 0) AS pv_own, coalesce(bonus_pb, 0) AS bonus_pb, {', '.join(f'coalesce(x_{n}, 0) AS bonus_{n}' for n in _NAMES)}, {', '.join(f'coalesce(lb{k}, 0) AS lb{k}' for k in range(10, 100, 10))}
        FROM ({' UNION '.join(f"SELECT b.user_id FROM b_{n} b LEFT JOIN month mo ON mo.user_id = b.user_id WHERE coalesce(mo.is_active, 0) = 0" for n in ('pe', 'se', 'gpb', 'crb', 'eab'))}
        UNION SELECT d.user_id FROM lbdet d JOIN month mo ON mo.user_id = d.user_id WHERE mo.is_active = 0 AND layer <= bonus_level) u LEFT JOIN members m USING (user_id) LEFT JOIN month mo USING (user_id) {_SUMS} LEFT JOIN (SELECT user_id, bonus_pb FROM b_pb) USING (user_id)
        LEFT JOIN (SELECT user_id, {', '.join(f'sum(bonus_lb) FILTER (layer = {k}) AS lb{k}' for k in range(10, 100, 10))} FROM lbdet WHERE layer <= bonus_level GROUP BY 1) USING (user_id)""",
    "shares": "SELECT user_id, country_id, sum(pv) AS pv, count(*) AS n_orders, count(DISTINCT src) AS n_users FROM (SELECT o.user_id, o.country_id, pv, o.user_id AS src FROM ord o UNION ALL SELECT ancestor, o.country_id, pv, o.user_id FROM ord o JOIN sup ON descendant = o.user_id) GROUP BY ALL",
}


def _m(*names: str, **scales: int) -> str:
    """Select items that turn cents into decimals, as the queries do."""
    both = {n: 2 for n in names} | scales
    return ", ".join(f"CAST({n} * {10 ** -s:.{s}f} AS DECIMAL(18, {s})) AS {n}" for n, s in both.items())


_ALL = [f"bonus_{n}" for n in _NAMES]
_MONTH = ["pv_own", "pv_zc", "pv_fx", "pv_team", "pv_1l", "pv_2l", "pre_surplus_1l", "pre_surplus_2l", "total_1l", "total_2l", "stockist_pv"]
_SELECTS = {
    "level_fee_commission": f"SELECT user_id, level, CAST(sum((CAST(amount AS HUGEINT) * ppm + 500000) // 1000000) * 0.01 AS DECIMAL(18, 2)) AS commission, count(*) AS n_orders FROM (SELECT ancestor AS user_id, level, amount FROM ord JOIN sup ON descendant = user_id) JOIN (VALUES {', '.join(f'({k}, {v})' for k, v in _FAMILIES['levelFee'].items())}) f(k, ppm) ON k = level GROUP BY user_id, level",
    "sponsor_depth": "SELECT user_id, s.depth AS sponsor_depth, p.depth AS placement_depth FROM sdepth s FULL JOIN pdepth p USING (user_id)",
    "generation_counts": "SELECT depth AS level, count(*) AS n FROM pdepth GROUP BY 1",
    "placement_closure": "SELECT ancestor, descendant, level, leg FROM pup",
    "buyer_ancestors": "SELECT descendant, ancestor, level FROM sup WHERE descendant IN (SELECT user_id FROM own)",
    "direct_children": "SELECT parent_id, string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY user_id) AS children FROM sponsor WHERE parent_id IN (SELECT user_id FROM own) GROUP BY 1",
    "placement_pv": f"SELECT user_id, {_m('pv_1l', 'pv_2l')} FROM legs",
    "placement_pv_by_closure": f"SELECT user_id, {_m('pv_1l', 'pv_2l')} FROM legs",
    "team_pv": f"SELECT user_id, depth, {_m('pv_own', 'pv_team')}, below AS buyers_below FROM team",
    "monthly_performance": f"SELECT user_id, {_m(*_MONTH)}, is_active, country_id FROM month",
    "placement_settlement": f"""SELECT user_id, {_m('pv_1l', 'pv_2l', 'pre_surplus_1l', 'pre_surplus_2l', 'total_1l', 'total_2l', 'remain_surplus_1l', 'remain_surplus_2l')} FROM (
        SELECT *, CASE WHEN busy THEN pv_1l + pre_surplus_1l ELSE 0 END AS total_1l, CASE WHEN busy THEN pv_2l + pre_surplus_2l ELSE 0 END AS total_2l, CASE WHEN busy THEN 0 ELSE pre_surplus_1l END AS remain_surplus_1l, CASE WHEN busy THEN 0 ELSE pre_surplus_2l END AS remain_surplus_2l FROM (
        SELECT user_id, coalesce(pv_1l, 0) AS pv_1l, coalesce(pv_2l, 0) AS pv_2l, coalesce(surplus_1l, 0) AS pre_surplus_1l, coalesce(surplus_2l, 0) AS pre_surplus_2l, coalesce(pv_own, 0) <> 0 OR coalesce(pv_1l, 0) <> 0 OR coalesce(pv_2l, 0) <> 0 OR coalesce(gpv, 0) <> 0 AS busy
        FROM sponsor LEFT JOIN legs USING (user_id) LEFT JOIN carry USING (user_id) LEFT JOIN (SELECT user_id, pv_own, gpv FROM rank) USING (user_id))) WHERE pv_1l <> 0 OR pv_2l <> 0 OR pre_surplus_1l <> 0 OR pre_surplus_2l <> 0""",
    "elite_bonus": f"SELECT user_id, parent_id, top_deep, {_m('gpv_real', 'bonus_e')} FROM b_e",
    "elite_bonus_source": f"SELECT source_id, bonus_id, {_m('source_pv')} FROM (SELECT s.user_id AS source_id, CASE WHEN s.elite = 10 THEN s.user_id ELSE (SELECT min_by(ancestor, level) FROM sup JOIN enet q ON q.user_id = ancestor AND q.elite = 10 WHERE descendant = s.user_id) END AS bonus_id, s.pv_own AS source_pv FROM enet s WHERE pv_own > 0) WHERE bonus_id IS NOT NULL",
    "elite_bonus_source_resting": f"SELECT source_id, bonus_id, {_m('source_pv')} FROM (SELECT s.user_id AS source_id, CASE WHEN s.elite = 10 THEN s.user_id ELSE coalesce((SELECT min_by(ancestor, level) FROM sup JOIN enet q ON q.user_id = ancestor AND q.elite = 10 WHERE descendant = s.user_id), (SELECT max_by(ancestor, level) FROM sup WHERE descendant = s.user_id), s.user_id) END AS bonus_id, s.pv_own AS source_pv FROM enet s WHERE pv_own > 0)",
    "elite_level": f"SELECT user_id, parent_id, top_deep, {_m('gpv', 'gpv_real', 'gpv_unreal')}, sons, elite_level FROM levels",
    "rank_snapshot": f"SELECT user_id, parent_id, {_m('gpv', 'contrib')}, legs, virtual_width, is_elite, rank FROM rank",
    "highest_rank": "SELECT user_id, r.rank AS current_rank, p.rank AS prev_highest, greatest(r.rank, p.rank) AS highest_rank, r.rank > p.rank AS rose FROM rank r JOIN prev p USING (user_id)",
    "pro_elite_bonus": f"SELECT user_id, {_m('base', 'bonus_pe')}, is_active FROM b_pe",
    "pro_elite_source": f"SELECT user_id, source_id, {_m('source_gpv', 'source_unreal')} FROM (SELECT b.user_id, k.user_id AS source_id, k.gpv_real AS source_gpv, 0 AS source_unreal FROM levels b JOIN levels k ON k.parent_id = b.user_id WHERE b.elite_level >= 20 AND k.gpv_real > 0 UNION ALL SELECT user_id, user_id, 0, gpv_unreal FROM levels WHERE elite_level >= 20 AND gpv_unreal > 0)",
    "super_elite_bonus": f"SELECT user_id, country_id, region_id, {_m('bonus_se')}, is_active FROM b_se",
    "honor_level": "SELECT user_id, legs_max, legs_90, legs_80, legs_70, ori, honor_limit, bonus, chain, last FROM honors",
    "honor_layer": f"SELECT user_id, layer, {_m('lb_pv')}, bonus FROM hlayers",
    "highest_honor": "SELECT user_id, before, last, highest FROM hhigh",
    "highest_honor_half_years": f"SELECT m.user_id, honor_before AS before, greatest(honor_before, coalesce(CASE WHEN n3 = 3 THEN least3 END, 0), coalesce(best[4], 0)) AS highest FROM members m LEFT JOIN (SELECT user_id, list(honor ORDER BY honor DESC) AS best, count(*) FILTER (period > {P - 4}) AS n3, min(honor) FILTER (period > {P - 4}) AS least3 FROM history WHERE period BETWEEN {P - 6} AND {P - 1} GROUP BY 1) USING (user_id)",
    "honor_rolling_counts": "SELECT user_id, period, honor, CAST(count(*) FILTER (honor >= 80) OVER w AS BIGINT) AS n80, CAST(count(*) FILTER (honor = 90) OVER w AS BIGINT) AS n90 FROM history WINDOW w AS (PARTITION BY user_id ORDER BY period RANGE BETWEEN 11 PRECEDING AND CURRENT ROW)",
    "leadership_bonus": f"SELECT user_id, country_id, {_m('ori_bonus_lb', 'bonus_lb')} FROM b_lb",
    "leadership_detail": f"SELECT user_id, layer, region_id, country_id, {_m('lb_pv', 'layer_pv', 'bonus_lb', lb_rate=6)} FROM lbdet",
    "team_bonus": f"SELECT user_id, country_id, {_m('touch_pv', 'surplus_1l', 'surplus_2l', 'bonus_tb', ori_base=4, base=4, tb_rate=6)} FROM b_tb",
    "team_carry_over": f"SELECT user_id, {_m('surplus_1l', 'surplus_2l', 'total_1l', 'total_2l')} FROM (SELECT coalesce(t.user_id, c.user_id) AS user_id, CASE WHEN t.user_id IS NULL THEN c.surplus_1l ELSE t.surplus_1l END AS surplus_1l, CASE WHEN t.user_id IS NULL THEN c.surplus_2l ELSE t.surplus_2l END AS surplus_2l, CASE WHEN t.user_id IS NULL THEN c.surplus_1l ELSE t.total_1l END AS total_1l, CASE WHEN t.user_id IS NULL THEN c.surplus_2l ELSE t.total_2l END AS total_2l FROM tmatch t FULL JOIN carry c ON c.user_id = t.user_id)",
    "performance_points": f"SELECT user_id, country_id, level, {_m('total_gpv', 'bonus_pb', 'pb_pv')} FROM b_pb",
    "stockist_fee": f"SELECT user_id, {_m('stockist_pv', 'pv_unity', 'pv_app', 'pv_otc', 'bonus_unity', 'bonus_app', 'bonus_otc', 'bonus_sfb')}, country_id FROM b_sfb",
    "global_pool": f"SELECT user_id, {_m('bonus_head', 'bonus_pv', 'bonus_gpb')}, is_active FROM b_gpb",
    "car_room_bonus": f"SELECT user_id, {_m('ori_car', 'bonus_car', 'ori_room', 'bonus_room', 'bonus_crb')}, is_active FROM b_crb",
    "achievement_bonus": f"SELECT user_id, {_m('gpv', 'bonus_eab', 'payable')}, country_id, region_id, is_active FROM b_eab",
    "total_bonus": f"SELECT user_id, country_id, is_active, {_m('total_bonus', 'total_points', *_ALL)} FROM tot WHERE total_bonus > 0 OR total_points > 0",
    "inactive_details": f"SELECT user_id, country_id, {_m('pv_own', 'bonus_pb', *_ALL, *[f'lb{k}' for k in range(10, 100, 10)])} FROM idle",
    "country_share_lb": f"SELECT c.user_id, c.order_country, m.country_id AS user_country, c.pv, c.n_orders, c.n_users, c.share, CAST(bonus_lb * 0.01 AS DECIMAL(18, 2)) AS bonus_lb, CAST(bonus_lb * e4 * 0.000001 AS DECIMAL(18, 6)) AS bonus_global FROM (SELECT s.user_id, country_id AS order_country, {_m('pv')}, n_orders, n_users, coalesce(CAST(pv AS HUGEINT) * 10000 // nullif(t.pv_team, 0), 0) AS e4, CAST(e4 * 0.0001 AS DECIMAL(18, 4)) AS share FROM shares s JOIN pss t USING (user_id)) c JOIN (SELECT user_id, bonus_lb FROM b_lb WHERE bonus_lb > 0) l USING (user_id) JOIN members m USING (user_id)",
    "descendants_below": "SELECT ancestor AS user_id, level, count(*) AS n FROM sup JOIN sdepth d ON d.user_id = ancestor WHERE d.depth = 2 AND level <= 3 GROUP BY ALL",
    "global_pool_low_layers": f"SELECT user_id, {_m('bonus_head', 'bonus_pv', 'bonus_gpb')}, is_active FROM b_gpo",
    "country_share": f"SELECT s.user_id, parent_id, country_id, {_m('pv')}, n_orders, n_users, CAST(coalesce(CAST(pv AS HUGEINT) * 10000 // nullif(t.pv_team, 0), 0) * 0.0001 AS DECIMAL(18, 4)) AS share FROM shares s JOIN sponsor USING (user_id) JOIN pss t USING (user_id)",
    "effectiveness": f"""SELECT user_id, since AS effect_month, {_m('effect_pv')}, CAST(strptime(since || '01', '%Y%m%d')::DATE + INTERVAL 11 MONTH >= DATE '1997-03-01' AS INT) AS effect_active FROM (
        SELECT m.user_id, CASE WHEN coalesce(p.pv % 3000, 0) + pv_own >= 3000 THEN '199703' WHEN p.user_id IS NULL THEN '199703' ELSE '199601' END AS since, CASE WHEN coalesce(p.pv % 3000, 0) + pv_own >= 3000 THEN 0 ELSE coalesce(p.pv % 3000, 0) + pv_own END AS effect_pv FROM month m LEFT JOIN past p USING (user_id))""",
    "rank_change_events": "SELECT user_id, p.rank AS old_value, r.rank AS new_value, CASE WHEN r.rank > p.rank THEN 'UP' ELSE 'DOWN' END AS direction FROM rank r JOIN prev p USING (user_id) WHERE r.rank <> p.rank",
    "integrity_report": """SELECT * FROM (VALUES (1, 'sponsor tree is connected'), (2, 'placement tree is connected'), (3, 'sponsor members are members'), (4, 'placement members are members'), (5, 'buyers are in the sponsor tree'), (6, 'buyers are in the placement tree'), (7, 'stockists are members'), (8, 'legs are 1 or 2'), (9, 'one placement parent'), (10, 'one child per leg'), (11, 'one sponsor parent'), (12, 'no member has the root''s id')) t(check_no, name),
        LATERAL (SELECT CAST(CASE check_no WHEN 1 THEN (SELECT count(*) FROM sponsor) - (SELECT count(*) FROM sdepth) + abs((SELECT count(*) FROM sponsor WHERE parent_id = -1) - 1) WHEN 2 THEN (SELECT count(*) FROM placement) - (SELECT count(*) FROM pdepth) + abs((SELECT count(*) FROM placement WHERE parent_id = -1) - 1)
        WHEN 3 THEN (SELECT count(DISTINCT user_id) FROM sponsor WHERE user_id NOT IN (SELECT user_id FROM members)) WHEN 4 THEN (SELECT count(DISTINCT user_id) FROM placement WHERE user_id NOT IN (SELECT user_id FROM members))
        WHEN 9 THEN (SELECT count(*) FROM (SELECT user_id FROM placement GROUP BY 1 HAVING count(*) > 1)) WHEN 10 THEN (SELECT count(*) FROM (SELECT parent_id, leg FROM placement WHERE parent_id <> -1 GROUP BY ALL HAVING count(*) > 1))
        WHEN 11 THEN (SELECT count(*) FROM (SELECT user_id FROM sponsor GROUP BY 1 HAVING count(*) > 1)) WHEN 12 THEN (SELECT count(*) FROM sponsor WHERE user_id = -1)
        WHEN 5 THEN (SELECT count(DISTINCT user_id) FROM ord WHERE user_id NOT IN (SELECT user_id FROM sponsor)) WHEN 6 THEN (SELECT count(DISTINCT user_id) FROM ord WHERE user_id NOT IN (SELECT user_id FROM placement))
        WHEN 7 THEN (SELECT count(DISTINCT stockist_id) FROM ord WHERE stockist_id NOT IN (SELECT user_id FROM members)) WHEN 8 THEN (SELECT count(*) FROM placement WHERE parent_id <> -1 AND leg NOT IN (1, 2)) ELSE 0 END AS BIGINT) AS violations)""",
    "honor_change_events": "SELECT user_id, before AS old_value, highest AS new_value, 'UP' AS direction FROM hhigh WHERE highest > before",
    "rank_snapshot_incremental": f"SELECT user_id, parent_id, {_m('gpv', 'contrib')}, legs, virtual_width, is_elite, rank FROM rank",
    "order_stream_state": f"SELECT user_id, {_m('gpv', 'contrib', 'pv_1l', 'pv_2l')}, legs, virtual_width, is_elite, rank FROM (SELECT r.*, coalesce(l.pv_1l, 0) AS pv_1l, coalesce(l.pv_2l, 0) AS pv_2l FROM rank r LEFT JOIN legs l USING (user_id))",
    "order_stream_events": "SELECT user_id, CAST(0 AS INT) AS old_value, CAST(rank AS INT) AS new_value FROM rank WHERE rank > 0",
    "elite_bonus_incremental": f"SELECT user_id, parent_id, top_deep, {_m('gpv_real', 'bonus_e')} FROM b_e",
    "member_pages": """SELECT * FROM (SELECT 'depth' AS by, CAST(depth AS BIGINT) AS key, user_id FROM sdepth WHERE (depth, user_id) > (4, 100) ORDER BY depth, user_id LIMIT 41)
        UNION ALL SELECT * FROM (SELECT 'parent' AS by, parent_id AS key, user_id FROM sponsor WHERE (parent_id, user_id) > (16, 50) ORDER BY parent_id, user_id LIMIT 41)""",
    "stockist_fee_from_backup": f"SELECT user_id, {_m('stockist_pv', 'pv_unity', 'pv_app', 'pv_otc', 'bonus_unity', 'bonus_app', 'bonus_otc', 'bonus_sfb')}, country_id FROM b_sfb",
    "published_members": "SELECT user_id, country_id, CAST(member_level AS INT) AS member_level FROM members",
    "performance_of_run": f"SELECT m.user_id, {_m('pv_own', 'pv_team')}, is_active, rank FROM (SELECT user_id, pv_own, pv_team, is_active FROM month) m LEFT JOIN (SELECT user_id, rank FROM rank) r USING (user_id)",
    "ragged_ranks": f"SELECT user_id, parent_id, depth, {_m('gpv', 'contrib')}, legs, virtual_width, is_elite, rank FROM grank",
    "ragged_elite_net": f"SELECT user_id, parent_id, depth, {_m('gpv', 'gpv_real')}, elite FROM gnet",
    "ragged_country_share": f"SELECT user_id, parent_id, country_id, {_m('pv')}, n_orders, n_users, CAST(coalesce(CAST(pv AS HUGEINT) * 10000 // nullif(sum(pv) OVER (PARTITION BY user_id), 0), 0) * 0.0001 AS DECIMAL(18, 4)) AS share FROM gshares JOIN ragged USING (user_id)",
    "decimal_functions": "SELECT c_custkey AS user_id, CAST(trunc(c_acctbal * 10) / 10 AS DECIMAL(18, 1)) AS cut, CAST(c_acctbal AS DECIMAL(18, 2)) AS read, CASE WHEN c_custkey % 12 = 0 THEN 199512 ELSE 199600 + c_custkey % 12 END AS month_before FROM customer",
    "cdc_merged_state": "SELECT user_id AS id, ts AS event_ts, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1 AND event_type <> 'error'",
    "cdc_latest_state": "SELECT user_id AS id, op, ts AS event_ts, event_id AS \"offset\", value, k FROM (SELECT *, CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' ELSE 'u' END AS op, CAST(json_extract_string(props, '$.k') AS INT) AS k, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1 AND op <> 'd'",
}


def _used(sql: str) -> list[str]:
    return [t for t in re.findall(r"\b(?:FROM|JOIN)\s+([a-z_0-9]+)|,\s*(crbpool)\b", sql) for t in t if t in T]


def with_tables(select: str) -> str:
    """A query with the tables it needs, in order."""
    order: list[str] = []

    def need(name: str) -> None:
        if name in order:
            return
        for other in _used(T[name]):
            if other != name:
                need(other)
        order.append(name)

    for name in _used(select):
        need(name)
    if not order:
        return select
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS {'' if n in _used(T[n]) else 'MATERIALIZED '}({T[n]})" for n in order) + "\n" + select


T |= {
    "xmembers": "SELECT * FROM members WHERE user_id % 97 <> 5",
    "xsponsor": "SELECT user_id, CASE WHEN user_id % 211 = 3 THEN user_id + 1000000000 ELSE parent_id END AS parent_id FROM sponsor UNION ALL SELECT user_id, 0 FROM sponsor WHERE user_id % 83 = 2 UNION ALL SELECT -1, 0",
    "xplacement": "SELECT user_id, CASE WHEN user_id % 223 = 9 THEN user_id + 1000000000 ELSE parent_id END AS parent_id, CASE WHEN user_id % 89 = 7 THEN 3 WHEN user_id % 89 = 8 THEN NULL ELSE leg END AS leg FROM placement UNION ALL SELECT user_id, 0, 1 FROM placement WHERE user_id % 79 = 4",
    "xord": "SELECT CASE WHEN user_id % 101 = 1 THEN user_id + 1000000000 ELSE user_id END AS user_id, CASE WHEN order_id % 103 = 1 THEN 1000000000 ELSE stockist_id END AS stockist_id FROM ord",
    "xsdepth": "SELECT user_id FROM xsponsor WHERE parent_id = -1 UNION SELECT s.user_id FROM xsponsor s JOIN xsdepth r ON s.parent_id = r.user_id",
    "xpdepth": "SELECT user_id FROM xplacement WHERE parent_id = -1 UNION SELECT s.user_id FROM xplacement s JOIN xpdepth r ON s.parent_id = r.user_id",
}
_PLANTED = re.sub(r"\bFROM (sponsor|placement|members|ord|sdepth|pdepth)\b", r"FROM x\1", _SELECTS["integrity_report"]).replace("leg NOT IN (1, 2)", "coalesce(leg, 0) NOT IN (1, 2)")
for _tree in ("s", "p"):  # members that come twice count twice, however often they are reached
    _name = {"s": "xsponsor", "p": "xplacement"}[_tree]
    _PLANTED = _PLANTED.replace(f"(SELECT count(*) FROM {_name}) - (SELECT count(*) FROM x{_tree}depth)", f"(SELECT count(*) FROM {_name} WHERE user_id NOT IN (SELECT user_id FROM x{_tree}depth))")
_SELECTS["integrity_report_planted"] = _PLANTED
_SELECTS["total_bonus_ids"] = f"SELECT '199701' || lpad(CAST(row_no AS VARCHAR), 8, '0') AS row_id, row_no, user_id, {_m('total_bonus')} FROM (SELECT row_number() OVER (ORDER BY total_bonus DESC, user_id) AS row_no, user_id, total_bonus FROM tot WHERE total_bonus > 0 OR total_points > 0)"
#: A number's hexadecimal digits, split where HUGEINT can hold the halves; a negative one less 16 to the power of its digits.
_SELECTS["decimal_bytes"] = """SELECT user_id, CAST(CAST(CASE WHEN neg THEN v - pow16 ELSE v END AS VARCHAR) AS DECIMAL(38, 0)) * CAST(0.0001 AS DECIMAL(5, 4)) AS read FROM (
    SELECT user_id, user_id % 3 = 0 AS neg, CAST(list_sum(list_transform(range(1, n + 1), lambda i: CAST(instr('0123456789ABCDEF', h[i]) - 1 AS HUGEINT) * (CAST(1 AS HUGEINT) << CAST(4 * (n - i) AS INT)))) AS HUGEINT) AS v, CAST(1 AS HUGEINT) << CAST(4 * n AS INT) AS pow16
    FROM (SELECT c_custkey AS user_id, least(c_custkey % 20 + 1, 15) * 2 AS n, upper(substr(sha256(CAST(c_custkey AS VARCHAR)), 1, CAST(least(c_custkey % 20 + 1, 15) * 2 AS INT))) AS h FROM customer))"""
_SELECTS["cdc_merge_on_read"] = _SELECTS["cdc_merged_state"]
ORACLE_SQL = {name: with_tables(sql) for name, sql in _SELECTS.items()}
