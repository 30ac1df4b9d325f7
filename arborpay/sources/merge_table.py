"""Tables of a change stream, merged when they are read.

A batch of changes is written as it is, in folders by hash bucket of the key; nothing else is rewritten. A
read takes the last base and the deltas after it, and of each key the change with the latest event time,
partition and offset, so the order in which batches arrive doesn't matter and a batch that comes twice
changes nothing. Compaction writes a new base; a vacuum deletes what no kept version needs.

A writer claims a number by creating an empty file exclusively, writes its data, and commits by an empty
file whose name holds the number, the kind, the last commit that a base covers, and the time.
"""

from __future__ import annotations

import time
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from arborpay.sources.files import Files
from arborpay.streaming.changes import REMEMBER

#: Deltas after a base from which maintain() compacts.
DELTAS = 8


class Commit(NamedTuple):
    number: int
    kind: str  # base or delta
    through: int  # a base holds all commits up to this one
    millis: int


class MergeTable:
    """A table under one path; any number of writers."""

    def __init__(self, spark: SparkSession, path: str, key: str = "id", buckets: int = 16):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self.files = Files(spark)

    def commits(self) -> list[Commit]:
        """All commits, in order."""
        names = (n.split("-") for n in self.files.names(f"{self.path}/commits"))
        return sorted(Commit(int(a), b, int(c), int(d)) for a, b, c, d in names)

    def version(self) -> int:
        """The last commit's number, 0 if there is none."""
        return max((c.number for c in self.commits()), default=0)

    def version_at(self, millis: int) -> int:
        """The last commit up to a time."""
        return max((c.number for c in self.commits() if c.millis <= millis), default=0)

    def _commit(self, rows: DataFrame, kind: str, through: int) -> int:
        number = self.files.claim(f"{self.path}/claims")
        bucket = F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.buckets)).cast("int")
        rows.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/commit={number}")
        self.files.create(f"{self.path}/commits/{number:012d}-{kind}-{through}-{time.time_ns() // 1_000_000}")
        return number

    def merge(self, rows: DataFrame) -> int:
        """Commit a batch of changes (key, op, event_ts, partition, offset, ...); an empty one commits nothing."""
        if rows.isEmpty():
            return self.version()
        return self._commit(rows.drop("bad"), "delta", 0)

    def _needed(self, version: int, commits: list[Commit]) -> list[Commit]:
        """What a read of a version takes: the base that covers most, and the deltas that it doesn't hold."""
        there = [c for c in commits if c.number <= version]
        base = max((c for c in there if c.kind == "base"), key=lambda c: (c.through, c.number), default=None)
        through = base.through if base else 0
        return ([base] if base else []) + [c for c in there if c.kind == "delta" and c.number > through]

    def whole(self, version: int | None = None) -> DataFrame:
        """The last change of each key, deletes too. Columns that came later are nulls in rows from before."""
        commits = self.commits()
        at = self.version() if version is None else version
        needed = self._needed(at, commits)
        if not needed:
            raise AnalysisException(f"no version {at} of {self.path}")
        read = self.spark.read.option("mergeSchema", "true").option("basePath", f"{self.path}/data")
        rows = read.parquet(*[f"{self.path}/data/commit={c.number}" for c in needed])
        rest = [c for c in rows.columns if c not in (self.key, "bucket", "commit")]
        last = F.max_by(F.struct(*rest), F.struct("event_ts", "partition", "offset")).alias("v")
        return rows.groupBy("bucket", self.key).agg(last).select("bucket", self.key, "v.*")

    def read(self, columns: list[str] | None = None, version: int | None = None) -> tuple[DataFrame, int]:
        """(live rows, version), of the named columns. A filter on ``bucket`` and key reads that bucket alone."""
        at = self.version() if version is None else version
        rows = self.whole(at).where("op <> 'd'").drop("op", "partition", "offset", "bucket")
        return (rows.select(*columns) if columns else rows), at

    def row(self, key: str) -> DataFrame:
        """The live row of one key, from its bucket's files alone."""
        bucket = self.spark.range(1).select(F.pmod(F.xxhash64(F.lit(key)), F.lit(self.buckets)).cast("int")).first()[0]
        return self.whole().where((F.col("bucket") == bucket) & (F.col(self.key) == key) & (F.col("op") != "d")).drop("bucket", "op", "partition", "offset")

    def compact(self) -> int:
        """Write a base of all commits there are. Deleted rows are remembered for REMEMBER before the newest change."""
        through = self.version()
        rows = self.whole(through)
        newest = rows.agg(F.max("event_ts").alias("_last"))
        kept = rows.crossJoin(F.broadcast(newest)).where((F.col("op") != "d") | (F.col("event_ts") >= F.col("_last") - F.expr(f"interval {REMEMBER}"))).drop("_last", "bucket")  # one row
        return self._commit(kept, "base", through)

    def maintain(self) -> None:
        """Compact where many deltas have come since the last base."""
        commits = self.commits()
        if sum(c.kind == "delta" for c in self._needed(self.version(), commits)) > DELTAS:
            self.compact()

    def keep(self, version: int) -> None:
        """Spare a version from every vacuum."""
        self.files.create(f"{self.path}/kept/{version}", replace=True)

    def vacuum(self, millis: int) -> list[int]:
        """Delete the data and commits that neither the current, nor a kept version, nor one committed after a time reads."""
        commits = self.commits()
        spared = {self.version(), *(int(n) for n in self.files.names(f"{self.path}/kept")), *(c.number for c in commits if c.millis > millis)}
        spared.add(max((c.number for c in commits if c.millis <= millis), default=0))  # what a read at that time gets
        needed = {c.number for v in spared for c in self._needed(v, commits)} | spared
        gone = [c for c in commits if c.number not in needed]
        for c in gone:
            self.files.delete(f"{self.path}/commits/{c.number:012d}-{c.kind}-{c.through}-{c.millis}")
            self.files.delete(f"{self.path}/data/commit={c.number}")
        return [c.number for c in gone]
