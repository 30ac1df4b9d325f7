"""Checks before a settlement, and of inputs: each fails loudly or reports a count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborpay.operators.tree import ROOT, reached
from arborpay.sources.workspace import Workspace


def reachable(ws: Workspace, edges: DataFrame) -> DataFrame:
    """One row (members, roots, unreached): members from which the root isn't reached, as orphans and what hangs on them or on a cycle."""
    cut_off = edges.select("user_id").join(reached(ws, edges).hint("merge"), "user_id", "left_anti").agg(F.count("*").alias("unreached"))
    counts = edges.agg(F.count("*").alias("members"), F.coalesce(F.sum((F.col("parent_id") == ROOT).cast("long")), F.lit(0)).alias("roots"))
    return counts.crossJoin(cut_off)  # one row each


def missing(of: DataFrame, within: DataFrame) -> DataFrame:
    """Members of one table that another lacks."""
    return of.select("user_id").distinct().join(within.select("user_id").hint("merge"), "user_id", "left_anti")


def integrity_report(ws: Workspace, members: DataFrame, sponsor: DataFrame, placement: DataFrame, orders: DataFrame) -> DataFrame:
    """(check_no, name, violations) of all checks; the first with violations is the one a settlement stops at."""
    one = placement.where("parent_id <> -1")
    stock = orders.where("stockist_id is not null").select(F.col("stockist_id").alias("user_id"))
    checks = [
        ("sponsor tree is connected", reachable(ws, sponsor).select((F.col("unreached") + F.abs(F.col("roots") - 1)).alias("n"))),
        ("placement tree is connected", reachable(ws, placement).select((F.col("unreached") + F.abs(F.col("roots") - 1)).alias("n"))),
        ("sponsor members are members", missing(sponsor, members).agg(F.count("*").alias("n"))),
        ("placement members are members", missing(placement, members).agg(F.count("*").alias("n"))),
        ("buyers are in the sponsor tree", missing(orders, sponsor).agg(F.count("*").alias("n"))),
        ("buyers are in the placement tree", missing(orders, placement).agg(F.count("*").alias("n"))),
        ("stockists are members", missing(stock, members).agg(F.count("*").alias("n"))),
        ("legs are 1 or 2", one.where("leg is null or leg not in (1, 2)").agg(F.count("*").alias("n"))),
        ("one placement parent", placement.groupBy("user_id").count().where("count > 1").agg(F.count("*").alias("n"))),
        ("one child per leg", one.groupBy("parent_id", "leg").count().where("count > 1").agg(F.count("*").alias("n"))),
        ("one sponsor parent", sponsor.groupBy("user_id").count().where("count > 1").agg(F.count("*").alias("n"))),
        ("no member has the root's id", sponsor.where(F.col("user_id") == ROOT).agg(F.count("*").alias("n"))),
    ]
    out = None
    for k, (name, n) in enumerate(checks, 1):
        row = n.select(F.lit(k).alias("check_no"), F.lit(name).alias("name"), F.col("n").cast("long").alias("violations"))
        out = row if out is None else out.unionByName(row)
    return out


def gate(report: DataFrame) -> tuple[bool, str]:
    """(passed, message) of a report: the first violated check, or that all hold."""
    first = report.where("violations > 0").orderBy("check_no").first()
    return (True, "ok") if first is None else (False, f"{first['name']}: {first['violations']} violations")


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """df without repeated rows; rows that share a key but differ raise."""
    distinct = df.dropDuplicates()
    clash = distinct.groupBy(*keys).count().where("count > 1").limit(5).collect()
    if clash:
        raise ValueError(f"keys with different values: {[tuple(r[k] for k in keys) for r in clash]}")
    return distinct


def require_amounts(df: DataFrame, column: str) -> DataFrame:
    """df, whose column (text or decimal) holds amounts of at most two decimals; floats, nulls and other text raise."""
    kind = df.schema[column].dataType.simpleString()
    if kind in ("float", "double"):
        raise ValueError(f"{column}: amounts must not be {kind}")
    text = F.trim(F.col(column).cast("string"))
    bad = df.where(text.isNull() | ~text.rlike(r"^[+-]?[0-9]+(\.[0-9]{1,2}0*)?$")).limit(3).collect()
    if bad:
        raise ValueError(f"{column}: not amounts: {[r[column] for r in bad]}")
    return df


def require_period(df: DataFrame, period: int, column: str = "period") -> DataFrame:
    """df, all of whose rows are of one period."""
    other = df.where(~F.expr(f"try_cast({column} as int)").eqNullSafe(F.lit(period))).limit(1).collect()
    if other:
        raise ValueError(f"rows of another period than {period}: {other[0][column]!r}")
    return df


def require_regions(regions: DataFrame, countries: DataFrame) -> DataFrame:
    """A country map without repeated countries, to known regions that map to themselves."""
    require_unique(regions.select("country_id", "region_id"), ["country_id"])
    unknown = regions.join(countries.select(F.col("country_id").alias("region_id")), "region_id", "left_anti")
    targets = regions.select(F.col("region_id").alias("country_id")).distinct()
    loose = targets.join(regions.where("country_id = region_id"), "country_id", "left_anti")
    if not unknown.isEmpty() or not loose.isEmpty():
        raise ValueError("country map: a region is unknown or doesn't map to itself")
    return regions
