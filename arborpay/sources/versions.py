"""Tables kept as versions: publish gates, blue/green publishing with roll-back, merges, and backups by period.

A table is a folder of version folders, and a log: empty files whose names hold a running number, the
version it names, that version's parent and the time; the last counts. A publish writes a new version, checks it and creates the next
pointer, which is there or isn't; nothing is ever without a pointer once it had one. One writer at a time.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from arborpay.sources.files import Files
from arborpay.streaming import changes


class GateError(ValueError):
    """A version that must not be published."""


def gate(df: DataFrame, key: str, source: DataFrame | None = None) -> int:
    """Rows of a version that may be published: not empty, the key there and unique, and as many keys as the source."""
    if key not in df.columns:
        raise GateError(f"no key column {key}")
    rows, keys = df.agg(F.count("*"), F.count_distinct(key)).first()
    if not rows:
        raise GateError("no rows")
    if rows != keys:
        raise GateError(f"{rows} rows with {keys} different keys")
    if source is not None:
        there = source.agg(F.count_distinct(key)).first()[0]
        if there != keys:
            raise GateError(f"{keys} keys, the source has {there}")
    return rows


class VersionedTable:
    """A Parquet table with versions under one path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._fs_path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._fs_path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._files = Files(spark)

    def version(self) -> int:
        """The published version, 0 if there is none."""
        return max(self._log(), default=(0, 0))[1]

    def _log(self) -> list[tuple[int, int, int, int]]:
        """(number, version, the version that it was published after, milliseconds) of all publications and roll-backs."""
        names = (n.split("-") for n in self._files.names(f"{self.path}/pointers"))
        return sorted(tuple(map(int, n)) for n in names)

    def _next(self) -> int:
        """A version that was never published."""
        return max((v for _, v, *_ in self._log()), default=0) + 1

    def parent(self, version: int) -> int:
        """The version that was live when this one was first published, 0 if none was."""
        return next((p for _, v, p, _ in self._log() if v == version), 0)

    def version_at(self, millis: int) -> int:
        """The version that was live at a time."""
        return max((x for x in self._log() if x[3] <= millis), default=(0, 0))[1]

    def read(self, columns: list[str] | None = None, version: int | None = None, newest: bool = False) -> tuple[DataFrame, int]:
        """(rows, version), of the named columns; with ``newest``, an older version under the current one's columns, nulls where it lacks them."""
        at = self.version() if version is None else version
        if not at:
            raise AnalysisException(f"no version of {self.path}")
        df = self.whole(at, self.whole(self.version()).schema if newest else None)
        if "gone" in df.columns:
            df = df.where("not gone").drop("gone")
        return (df.select(*columns) if columns else df), at

    def whole(self, version: int, schema: T.StructType | None = None) -> DataFrame:
        """Rows of a version, after merges also those deleted of late, marked ``gone``."""
        read = self.spark.read.schema(schema) if schema else self.spark.read
        return read.parquet(f"{self.path}/v{version}")

    def publish(self, df: DataFrame, key: str, source: DataFrame | None = None, partitions: int | None = None) -> int:
        """Write, check and publish a version; whatever fails, the current one stays."""
        at = self._next()
        folder = self._fs_path(f"{self.path}/v{at}")
        (df.repartition(partitions) if partitions else df).write.mode("overwrite").parquet(folder.toString())
        try:
            gate(self.spark.read.parquet(folder.toString()), key, source)
        except GateError:
            self._fs.delete(folder, True)
            raise
        self._point(at)
        return at

    def _point(self, version: int, parent: int | None = None) -> None:
        number = max(self._log(), default=(0,))[0] + 1
        parent = self.version() if parent is None else parent
        self._files.create(f"{self.path}/pointers/{number:012d}-{version}-{parent}-{time.time_ns() // 1_000_000}")

    def roll_back(self) -> int:
        """Point to the version that was live before the current one was published; one that was withdrawn doesn't come back."""
        at = self.parent(self.version())
        if not at or not self._files.exists(f"{self.path}/v{at}"):
            raise AnalysisException(f"no version of {self.path} before the current one")
        self._point(at, self.parent(at))
        return at

    def merge(self, rows: DataFrame, key: str = "id") -> int:
        """Publish the table after a batch of newest changes; an empty batch publishes nothing."""
        if rows.isEmpty():
            return self.version()
        if not self.version():
            out = rows.withColumn("gone", F.col("op") == "d").drop("op", "partition", "offset", "bad")
        else:
            out = changes.merged(self.whole(self.version()), rows, key)
        at = self._next()
        out.write.mode("overwrite").parquet(f"{self.path}/v{at}")
        self._point(at)
        return at


def jdbc(spark: SparkSession, url: str, table: str, user: str, password: str, fetch: int = 10_000) -> DataFrame:
    """Rows of a database table, or of a subquery given as ``(...) alias``."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, user=user, password=password, fetchsize=str(fetch)).load()


class LeaseError(ValueError):
    """Another driver holds the period, or has taken it over."""


class PeriodRuns:
    """Which periods take orders, and the results of each, published together.

    A period's status is the last of its events, empty files whose names hold a fence, a number, the status, a
    step and the run. A run begins by creating its fence, the next number of the period, exclusively: of two
    drivers one gets it. Its events are its heartbeat; a run that has said nothing for ``lease`` seconds
    of the store's clock is taken for lost, and the next may begin. Whatever the lost one still says carries
    a lower fence and is refused. A period settles only after the one before. All result tables of a run
    lie in one folder; the event that ends the run makes all of them the period's results at once.
    """

    def __init__(self, spark: SparkSession, path: str, lease: float = 600):
        self.spark, self.path, self.lease = spark, path.rstrip("/"), lease
        self._files = Files(spark)

    def _events(self, period: int) -> list[tuple[int, int, str, str, str]]:
        """(fence, number, status, step, run) of a period, in order."""
        names = (n.split("-") for n in self._files.names(f"{self.path}/status/{period}"))
        return sorted((int(a), int(b), c, d, e) for a, b, c, d, e in names)

    def _name(self, period: int, event: tuple[int, int, str, str, str]) -> str:
        return f"{self.path}/status/{period}/{event[0]:08d}-{event[1]:06d}-{'-'.join(event[2:])}"

    def _say(self, period: int, fence: int, status: str, run: str, step: str = "") -> None:
        number = max((b for a, b, *_ in self._events(period) if a == fence), default=0) + 1
        self._files.create(self._name(period, (fence, number, status, step, run)))

    def _fences(self, period: int) -> list[int]:
        return [int(n) for n in self._files.names(f"{self.path}/fences/{period}")]

    def status(self, period: int) -> str:
        """OPEN, RUNNING, LOST, DONE or FAILED."""
        events = self._events(period)
        if not events:
            return "OPEN"
        last = events[-1]
        if last[2] == "RUNNING" and self._files.age(self._name(period, last), f"{self.path}/clock") > self.lease:
            return "LOST"
        return last[2]

    def steps(self, period: int) -> list[tuple[str, str]]:
        """(status, step) of all events of a period, in order."""
        return [(e[2], e[3]) for e in self._events(period)]

    def writable(self, period: int) -> bool:
        return self.status(period) == "OPEN"

    def guard(self, period: int) -> None:
        """Raise unless the period takes orders; writers ask before they write."""
        if not self.writable(period):
            raise LeaseError(f"period {period} is closed to orders: {self.status(period)}")

    def begin(self, period: int, first: bool = False) -> str:
        """Start a run and return its name; what a lost run began is begun anew."""
        if not first and self.status(period - 1) != "DONE":
            raise ValueError(f"period {period - 1} isn't settled")
        fences = self._fences(period)
        if self.status(period) == "RUNNING":
            raise LeaseError(f"period {period} is being settled")
        fence = max(fences, default=0) + 1
        said = {e[0] for e in self._events(period)}
        if fences and fence - 1 not in said and self._files.age(f"{self.path}/fences/{period}/{fence - 1:08d}", f"{self.path}/clock") <= self.lease:
            raise LeaseError(f"period {period} is just being begun")
        if not self._files.create(f"{self.path}/fences/{period}/{fence:08d}"):
            raise LeaseError(f"another driver begins period {period}")
        run = uuid.uuid4().hex
        self._say(period, fence, "RUNNING", run, "prepared")
        return run

    def _held(self, period: int, run: str) -> int:
        """The run's fence, if no later one is there and it hasn't ended."""
        own = [e for e in self._events(period) if e[4] == run]
        if not own or own[-1][2] != "RUNNING" or own[-1][0] != max(self._fences(period)):
            raise LeaseError(f"period {period} isn't settled by this run")
        return own[-1][0]

    def beat(self, period: int, run: str, step: str = "calculating") -> None:
        """Say that the run goes on, and with which step."""
        if not step.isidentifier():
            raise ValueError(f"not a name: {step!r}")
        self._say(period, self._held(period, run), "RUNNING", run, step)

    def end(self, period: int, run: str, results: dict[str, DataFrame] | None) -> None:
        """Write a run's results and publish them together; without results, or where one can't be written, the run failed."""
        fence = self._held(period, run)
        try:
            for name, df in (results or {}).items():
                df.write.mode("overwrite").parquet(f"{self.path}/runs/{run}/{name}")
                self.beat(period, run, "written")
        except LeaseError:
            raise
        except Exception:
            self._say(period, fence, "FAILED", run, "error")
            raise
        self._held(period, run)
        self._say(period, fence, "FAILED" if results is None else "DONE", run)

    def read(self, period: int, name: str) -> DataFrame:
        """A result of the period's last run that ended well."""
        done = [run for *_, status, _, run in self._events(period) if status == "DONE"]
        if not done:
            raise AnalysisException(f"no results of period {period}")
        return self.spark.read.parquet(f"{self.path}/runs/{done[-1]}/{name}")


def back_up(results: dict[str, DataFrame], path: str, period: int) -> None:
    """Keep results under <path>/<name>/period=<period>; a period that is there is replaced."""
    for name, df in results.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}/period={period}")


def of_period(spark: SparkSession, path: str, name: str, period: int) -> DataFrame:
    """Results of one period, read from its folder alone."""
    return spark.read.parquet(f"{path}/{name}/period={period}")
