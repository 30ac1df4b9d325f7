"""Numbers of the rows of a whole result, in an order, without one task that sees all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborpay.sources.workspace import Workspace

#: A row's place within its partition are the low bits of monotonically_increasing_id().
_LOW = 2**33 - 1


def numbered(ws: Workspace, df: DataFrame, order: list[Column], name: str = "row_no") -> DataFrame:
    """df with the number of each row, from 1, in an order; rows that tie are numbered in any order among themselves.

    Rows are dealt to partitions by ranges of the order and written once with their place in it. Partitions
    are counted, and a partition's first number is the sum of those before: a row per partition.
    """
    columns = df.columns
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = ws.table(sorted_.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW)).alias("_at")), "numbered")
    ahead = F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    firsts = placed.groupBy("_part").agg(F.count("*").alias("n")).select("_part", ahead.alias("_ahead"))
    firsts = ws.table(firsts, "firsts")
    return placed.join(F.broadcast(firsts), "_part").select(*columns, (F.col("_ahead") + F.col("_at") + 1).alias(name))  # a row per partition
