"""Folds over deep forests by heavy paths.

A member's heaviest child continues its path, every other child begins one. A path that hangs on another has
at most half of the members below the place where it hangs, so paths fall into as many levels as the number
of members has bits, and a level needs only those below it. Each level is a job: what its paths were given is
summed up, and each path is walked once from its lower end, with the state of one member in hand. A chain of
any length is one path, so a deep tree takes a few dozen jobs where a fold by depth takes one for each step.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from arborpay.operators import tree
from arborpay.sources.workspace import Workspace


class Rule(NamedTuple):
    """A fold's rule for one member: its results from its own columns and what its children gave, by name."""

    row: Callable[[dict, dict], dict]
    #: What a finished member gives its parent; None gives nothing.
    give: Callable[[dict], dict]
    #: How two gifts of a name become one.
    join: dict[str, Callable]


def added(a, b):
    """Of two gifts, of which neither is None."""
    return a + b


def joined(rule: Rule, a: dict, b: dict) -> dict:
    """Both gifts together."""
    return {k: b[k] if a[k] is None else a[k] if b[k] is None else f(a[k], b[k]) for k, f in rule.join.items()}


def sizes(ws: Workspace, edges: DataFrame) -> DataFrame:
    """(user_id, parent_id, depth, size): depth below the root, and members of the subtree, itself included, in one doubling."""
    start = edges.select("user_id", "parent_id", F.col("parent_id").alias("up"), F.lit(0).alias("depth"), F.lit(1).cast("long").alias("size"))
    rows, left = ws.counted(start, "sizes", f"up <> {tree.ROOT}")
    for _ in range(left.bit_length() + 2):
        if not left:
            return rows.drop("up")
        given = rows.where(F.col("up") != tree.ROOT).groupBy(F.col("up").alias("user_id")).agg(F.sum("size").alias("more"))
        over = rows.select(F.col("user_id").alias("_up"), F.col("up").alias("up2"), F.col("depth").alias("depth2"))
        moved = tree.with_key(rows.join(given.hint("merge"), "user_id", "left")).join(over.hint("merge"), "_up", "left")
        hop = F.when(F.col("up") != tree.ROOT, F.col("depth2") + 1).otherwise(0)
        moved = moved.select("user_id", "parent_id", F.when(F.col("up") == tree.ROOT, F.lit(tree.ROOT)).otherwise(F.coalesce("up2", F.lit(-2))).alias("up"), (F.col("depth") + F.coalesce(hop, F.lit(0))).cast("int").alias("depth"), (F.col("size") + F.coalesce("more", F.lit(0))).alias("size"))
        before = left
        rows, left = ws.counted(moved, "sizes", f"up <> {tree.ROOT}")
        if left == before or not rows.where("up = -2").isEmpty():
            break
    raise tree.TreeError("a cycle, or members with no path to the root")


def decompose(ws: Workspace, edges: DataFrame) -> DataFrame:
    """(user_id, parent_id, depth, path, level, up): each member's path, named by its top member, and that path's level.

    ``up`` is the level of the path that a path's top member hangs on, -1 for all other members and for roots.
    """
    sized = sizes(ws, edges)
    heavy = sized.groupBy("parent_id").agg(F.max(F.struct("size", "user_id"))["user_id"].alias("heavy")).where(F.col("parent_id") != tree.ROOT)
    kids = sized.join(heavy.select(F.col("heavy").alias("user_id"), F.lit(False).alias("begins")).hint("merge"), "user_id", "left")
    kids = ws.table(kids.withColumn("begins", F.coalesce("begins", F.lit(True))), "heavy")
    heads = tree.nearest(ws, kids, kids.where("begins"), itself=True).withColumnRenamed("nearest", "path")
    level = kids.where("begins").select(F.col("user_id").alias("path"), (F.length(F.bin("size")) - 1).alias("level"))
    placed = ws.table(kids.join(heads.hint("merge"), "user_id").join(level.hint("merge"), "path"), "levels")
    above = placed.where("begins").select("user_id", "parent_id").join(placed.select(F.col("user_id").alias("parent_id"), F.col("level").alias("up")).hint("merge"), "parent_id").select("user_id", "up")
    out = placed.join(above.hint("merge"), "user_id", "left").select("user_id", "parent_id", "depth", "path", "level", F.coalesce("up", F.lit(-1)).alias("up"))
    return ws.table(out, "paths")


def _walk(rule: Rule, own: list[str], given: list[str], schema: T.StructType) -> Callable:
    """Rows come by path, the lowest first; only the member below is held."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, below = None, None
        for batch in batches:
            out = []
            gifts = batch.select(given).to_pylist()
            for row, gift, at, up in zip(batch.select(own).to_pylist(), gifts, batch.column("_path").to_pylist(), batch.column("_up").to_pylist(), strict=True):
                if at == path:
                    gift = joined(rule, gift, rule.give(below))
                path, below = at, row | rule.row(row, gift)
                out.append(below | {"_up": up})
            yield pa.RecordBatch.from_pylist(out, arrow)

    return run


def levels_of(ws: Workspace, placed: DataFrame, step: Callable[[DataFrame, DataFrame | None], DataFrame], name: str) -> DataFrame:
    """All rows that ``step`` makes of each level's members and the finished rows of the tops that hang on them, from the lowest level up.

    ``placed`` has a row or more for each member, with ``_level``. The rows have ``_up``, the level of the path that a top
    hangs on, -1 for other members. Both are folders of one table, so a level reads its own tops alone, and the result is
    one scan.
    """
    placed = ws.table(placed, f"{name}-members", partition_by=("_level",))
    root, schema, done = ws.folder(name), None, []
    for (level,) in sorted(placed.select("_level").distinct().collect()):  # as many as the number of members has bits
        tops = None
        if done:
            tops = ws.spark.read.schema(schema).option("basePath", root).parquet(*done).where(F.col("_up") == level)
        rows = step(placed.where(F.col("_level") == level), tops)
        schema = schema or T.StructType([*rows.schema.fields, T.StructField(tree.STEP, T.IntegerType())])
        done.append(f"{root}/{tree.STEP}={level}")
        ws.table_at(rows, done[-1], partition_by=("_up",))
    return ws.spark.read.schema(schema).option("basePath", root).parquet(*done).drop("_up", tree.STEP)


def fold(ws: Workspace, nodes: DataFrame, gives: dict[str, tuple[Column, str]], schema: T.StructType, rule: Rule) -> DataFrame:
    """What tree.fold() gives, for rows of a ``schema``, by a rule that says the same of one member."""
    own = nodes.columns
    placed = decompose(ws, nodes.select("user_id", "parent_id"))
    members = nodes.join(placed.select("user_id", *[F.col(c).alias(f"_{c}") for c in ("path", "level", "up")]).hint("merge"), "user_id")
    out = T.StructType([*schema.fields, T.StructField("_up", T.IntegerType())])

    def step(level: DataFrame, tops: DataFrame | None) -> DataFrame:
        if tops is None:
            level = level.select("*", *[F.lit(None).cast(kind).alias(name) for name, (_, kind) in gives.items()])
        else:
            given = tops.groupBy(F.col("parent_id").alias("user_id")).agg(*[x.cast(kind).alias(name) for name, (x, kind) in gives.items()])
            level = level.join(given.hint("merge"), "user_id", "left")
        rows = level.select(*own, "_path", "_up", *gives).repartition("_path").sortWithinPartitions("_path", F.desc("depth"))
        return rows.mapInArrow(_walk(rule, own, list(gives), out), out)

    return levels_of(ws, members, step, "path-fold").select(schema.names)
