"""Change streams: envelopes to rows, newest-wins, merges into versioned tables, and differences as events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def envelope(payload: str) -> T.StructType:
    """The schema of a change envelope around rows of a schema in DDL."""
    row = T.StructType.fromDDL(payload)
    return T.StructType([T.StructField("before", row), T.StructField("after", row), T.StructField("op", T.StringType()), T.StructField("ts_ms", T.LongType())])


def parse(messages: DataFrame, payload: str) -> DataFrame:
    """Change rows of raw messages (topic, partition, offset, timestamp, key, value).

    A null value is a tombstone and deletes; the id comes from the row after, the row before, the
    key's JSON, or the bare key. Messages without an id, or whose JSON can't be read, are marked ``bad``, and
    so are rows that aren't deleted and have a placement ('0' and null are none) but a leg other than 1 and 2.
    """
    value, key = F.col("value").cast("string"), F.col("key").cast("string")
    read = messages.withColumn("m", F.from_json(value, envelope(payload))).withColumn("k", F.from_json(key, "id string")["id"])
    fields = [f.name for f in T.StructType.fromDDL(payload) if f.name != "id"]
    bare = F.when(~key.startswith("{"), key)
    ident = F.coalesce(F.col("m.after.id").cast("string"), F.col("m.before.id").cast("string"), F.col("k"), bare)
    op = F.when(value.isNull(), "d").otherwise(F.col("m.op"))
    ts = F.coalesce(F.expr("timestamp_millis(m.ts_ms)"), F.col("timestamp"))
    bad = ident.isNull() | op.isNull() | ~op.isin("c", "r", "u", "d")
    row = {f: F.coalesce(f"m.after.{f}", f"m.before.{f}") for f in fields}
    if "placementId" in row and "placementLeg" in row:
        placed = F.coalesce(row["placementId"].cast("string"), F.lit("0")) != "0"
        bad = bad | ((op != "d") & placed & ~F.coalesce(row["placementLeg"], F.lit(0)).isin(1, 2))
    return read.select(ident.alias("id"), op.alias("op"), ts.alias("event_ts"), "partition", "offset", *[c.alias(f) for f, c in row.items()], F.coalesce(bad, F.lit(True)).alias("bad"))


def newest(rows: DataFrame, key: str) -> DataFrame:
    """The last change of each key, by event time, partition and offset: one aggregate, no sort of a key's rows."""
    rest = [c for c in rows.columns if c not in (key, "event_ts", "partition", "offset")]
    last = F.max_by(F.struct(*rest), F.struct("event_ts", "partition", "offset")).alias("v")
    agg = rows.groupBy(key).agg(F.max(F.struct("event_ts", "partition", "offset")).alias("t"), last)
    return agg.select(key, "t.event_ts", "t.partition", "t.offset", *[F.col(f"v.{c}").alias(c) for c in rest])


#: How long a deleted row is remembered, so that an older change that comes late doesn't revive it.
REMEMBER = "30 days"


def merged(table: DataFrame, rows: DataFrame, key: str = "id", remember: str = REMEMBER) -> DataFrame:
    """The table after a batch of newest changes, with ``gone``: deleted rows stay for a time after the newest change.

    A change takes effect only if it is newer than the row it meets, deletes too, and deleted rows
    count as met; inserts need no row. ``table`` may have ``gone``. Columns that either side lacks come
    out as nulls.
    """
    if "gone" not in table.columns:
        table = table.withColumn("gone", F.lit(False))
    table = table.withColumn("op", F.when(F.col("gone"), "d").otherwise("r")).drop("gone")
    rows = rows.drop("partition", "offset", "bad")
    marked = table.withColumn("_in", F.lit(0)).unionByName(rows.withColumn("_in", F.lit(1)), allowMissingColumns=True)
    own = [c for c in marked.columns if c not in (key, "event_ts")]
    # Of two rows with the same time the one that is there stays.
    best = F.max_by(F.struct("event_ts", *own), F.struct("event_ts", -F.col("_in"))).alias("v")
    out = marked.groupBy(key).agg(best).select(key, "v.*")
    out = out.withColumn("gone", F.col("op") == "d").drop("op", "_in")
    newest_of_all = out.agg(F.max("event_ts").alias("_last"))
    stays = ~F.col("gone") | (F.col("event_ts") >= F.col("_last") - F.expr(f"interval {remember}")) if dict(out.dtypes)["event_ts"].startswith("timestamp") else F.lit(True)
    return out.crossJoin(F.broadcast(newest_of_all)).where(stays).drop("_last")  # one row


def merge(table: DataFrame, rows: DataFrame, key: str = "id") -> DataFrame:
    """The live rows of the table after a batch of newest changes."""
    return merged(table, rows, key).where("not gone").drop("gone")


def diff(old: DataFrame, new: DataFrame, key: str, value: str, only_up: bool = False) -> DataFrame:
    """Change events of a value between two snapshots: UP, DOWN, or only rises."""
    rows = new.select(key, F.col(value).alias("new_value")).join(old.select(key, F.col(value).alias("old_value")).hint("merge"), key, "full_outer")
    rows = rows.select(key, F.coalesce("old_value", F.lit(0)).alias("old_value"), F.coalesce("new_value", F.lit(0)).alias("new_value"))
    rows = rows.where("new_value > old_value" if only_up else "new_value <> old_value")
    return rows.withColumn("direction", F.when(F.col("new_value") > F.col("old_value"), "UP").otherwise("DOWN"))


def notices(rows: DataFrame, version: int) -> DataFrame:
    """Messages (key, value) that publish changed rows: the version as key, each row as JSON."""
    return rows.select(F.lit(str(version)).alias("key"), F.to_json(F.struct("*")).alias("value"))
