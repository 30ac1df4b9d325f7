"""A settlement domain over order tables: members, two trees, orders, settings and what earlier periods left.

The order tables have no member trees, so both are laid out over the dense customer keys: three children
per sponsor, two per placement. A period is a quarter, counted as year * 4 + quarter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborpay.functions.config import Config
from arborpay.functions.money import to_cents
from arborpay.sources.workspace import Workspace

#: The quarter that the registered queries settle.
PERIOD = 7989


@dataclass
class Domain:
    """Inputs of a settlement; each table as its comment says."""

    ws: Workspace
    period: int
    config: Config
    members: DataFrame  # user_id, country_id, member_level, is_founder, listed_active, honor_before
    regions: DataFrame  # country_id, region_id
    sponsor: DataFrame  # user_id, parent_id
    placement: DataFrame  # user_id, parent_id, leg
    orders: DataFrame  # order_id, period, user_id, country_id, pv, dec_type, type_id, stockist_id
    enrolled: DataFrame  # user_id, kind, end_period, capping
    history: DataFrame  # user_id, period, honor

    def of_period(self, period: int | None = None) -> DataFrame:
        return self.orders.where(F.col("period") == (self.period if period is None else period))


def load(spark: SparkSession, sf_dir: str, period: int = PERIOD, config: Config | None = None) -> Domain:
    """The domain of a folder of order tables."""

    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    customer = read("customer")
    key = F.col("c_custkey")
    members = customer.select(
        key.alias("user_id"),
        F.col("c_nationkey").alias("country_id"),
        ((key % 4 + 1) * 10).cast("int").alias("member_level"),
        (key % 17 == 0).cast("int").alias("is_founder"),
        (F.col("c_acctbal") > 9000).alias("listed_active"),
        (key % 7 * 10).cast("int").alias("honor_before"),
    )
    sponsor = customer.select(key.alias("user_id"), F.when(key == 0, F.lit(-1)).otherwise(F.floor((key - 1) / 3)).cast("long").alias("parent_id"))
    leg = F.when(key == 0, F.lit(0)).otherwise((key - 1) % 2 + 1).cast("int")
    placement = customer.select(key.alias("user_id"), F.when(key == 0, F.lit(-1)).otherwise(F.floor((key - 1) / 2)).cast("long").alias("parent_id"), leg.alias("leg"))
    cents = to_cents(F.col("o_totalprice"))
    date = F.col("o_orderdate")
    orders = read("orders").select(
        F.col("o_orderkey").alias("order_id"),
        (F.year(date) * 4 + F.quarter(date)).cast("int").alias("period"),
        F.col("o_custkey").alias("user_id"),
        F.expr("(cast(round(o_totalprice * 100) as bigint) * 5 + 500) div 1000").alias("pv"),
        cents.alias("amount"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "ZC").otherwise("FX").alias("dec_type"),
        (F.col("o_orderkey") % 3 + 1).cast("int").alias("type_id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.floor(F.col("o_custkey") / 7).cast("long")).alias("stockist_id"),
    )
    orders = orders.join(members.select("user_id", "country_id").hint("merge"), "user_id", "left")
    enrolled = customer.where(key % 20 == 0).select(key.alias("user_id"), F.lit("CAR").alias("kind"), (key % 3 + period - 1).cast("int").alias("end_period"), F.lit(50_000).cast("long").alias("capping"))
    enrolled = enrolled.unionByName(customer.where(key % 25 == 0).select(key.alias("user_id"), F.lit("ROOM").alias("kind"), (key % 3 + period - 1).cast("int").alias("end_period"), F.lit(30_000).cast("long").alias("capping")))
    past = orders.where(F.col("period").between(period - 15, period - 1)).groupBy("user_id", "period").agg(F.sum("pv").alias("pv"))
    history = past.select("user_id", "period", F.least(F.lit(90), F.expr("pv div 10000 * 10")).cast("int").alias("honor"))
    regions = read("nation").select(F.col("n_nationkey").alias("country_id"), F.col("n_regionkey").alias("region_id"))
    return Domain(Workspace(spark, "settlement"), period, config or Config(), members, regions, sponsor, placement, orders, enrolled, history)


def ragged_sponsor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another sponsor tree over the same keys: a fifth of all members is one chain, a fifth a star around member 0, others hang on these."""
    key = F.col("c_custkey")
    parent = F.when(key == 0, F.lit(-1)).when(key % 5 == 1, F.greatest(key - 5, F.lit(0))).when(key % 5 == 2, F.lit(0)).when(key % 5 == 3, F.floor(key / 7)).when(key % 5 == 4, key - 1).otherwise(F.floor((key - 1) / 3))
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(key.alias("user_id"), parent.cast("long").alias("parent_id"))
