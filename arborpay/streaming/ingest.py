"""Structured Streaming ingestion: messages by topic into tables, with dead letters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from arborpay.sources.files import Files
from arborpay.sources.merge_table import MergeTable
from arborpay.streaming import changes

MESSAGES = "topic string, partition int, offset long, timestamp timestamp, key string, value string"
#: Columns of the dimension streams beside the change's own.
USER = "id string, user string, parent string, placementId string, placementLeg int, updatetime long"
RATES = "id string, rate string, level string, updatetime long"
USER_INFO = "id string, user_name string, real_name string, country_id int, updatetime long"


def kafka(spark: SparkSession, servers: str, topics: list[str]) -> DataFrame:
    """A stream of messages from the earliest offset on; lost segments don't end it."""
    raw = spark.readStream.format("kafka").options(subscribe=",".join(topics), startingOffsets="earliest", failOnDataLoss="false").option("kafka.bootstrap.servers", servers).load()
    return raw.select("topic", "partition", "offset", "timestamp", F.col("key").cast("string"), F.col("value").cast("string"))


def files(spark: SparkSession, path: str) -> DataFrame:
    """The same columns from JSON files that arrive in a folder."""
    return spark.readStream.schema(MESSAGES).json(path)


#: Failures of a topic's batch after which its bad rows are looked for.
ATTEMPTS = 5


class Ingest:
    """Applies micro-batches to one merge-on-read table per topic.

    Each topic's processor gets that topic's messages alone. A batch id that a topic has seen is
    skipped, so a replayed batch changes nothing. Messages that can't be read go to the dead letters. A
    topic that fails for any other reason doesn't stop the others, but fails the batch after them, unmarked:
    the stream replays it, and no message is lost. Failures are counted in the shared folder, by topic
    and batch, so they outlast a driver; from the ATTEMPTS-th on the batch is halved until what fails stands
    alone, which goes to the dead letters with its error, and everything else is applied.
    """

    def __init__(self, spark: SparkSession, path: str, topics: dict[str, str], processors: dict[str, Callable[[DataFrame, int], None]] | None = None):
        """``topics``: columns by topic; ``processors``: what takes a topic's messages in place of its table. One must stand being given a message twice."""
        self.spark, self.path, self.topics = spark, path.rstrip("/"), topics
        self.processors = processors or {}
        self.files = Files(spark)

    def table(self, topic: str) -> MergeTable:
        return MergeTable(self.spark, f"{self.path}/tables/{topic}")

    def _letters(self, rows: DataFrame, batch: int, topic: str, kind: str, error: str | None = None) -> None:
        rows.withColumn("error", F.lit(error).cast("string")).write.mode("overwrite").parquet(f"{self.path}/dead/topic={topic}/batch={batch}/kind={kind}")

    def dead(self, topic: str) -> DataFrame:
        """A topic's dead letters, with the error where a processor raised one."""
        return self.spark.read.option("mergeSchema", "true").parquet(f"{self.path}/dead/topic={topic}")

    def attempts(self, topic: str, batch: int) -> int:
        """How often a batch of a topic has failed."""
        return len(self.files.names(f"{self.path}/attempts/{topic}/{batch}"))

    def _into_table(self, topic: str, messages: DataFrame, batch: int, part: str) -> None:
        rows = changes.parse(messages, self.topics[topic])
        bad = rows.where("bad")
        if not bad.isEmpty():
            self._letters(bad, batch, topic, f"unread{part}")
        table = self.table(topic)
        table.merge(changes.newest(rows.where("not bad"), "id").drop("bad"))
        table.maintain()

    def _process(self, topic: str, messages: DataFrame, batch: int, part: str = "") -> None:
        if topic in self.processors:
            self.processors[topic](messages, batch)
        else:
            self._into_table(topic, messages, batch, part)

    def _halve(self, topic: str, messages: DataFrame, batch: int, depth: int = 0, bits: int = 0) -> None:
        """Process the messages whose hash begins with some bits, in halves where they fail."""
        place = F.pmod(F.xxhash64("partition", "offset"), F.lit(2**depth))
        own = messages.where(place == bits)
        few = len(own.limit(2).collect())
        if not few:
            return
        try:
            self._process(topic, own, batch, f"-{depth}-{bits}")
        except Exception as error:  # noqa: BLE001  whatever a processor raises
            if few == 1 or depth == 62:
                self._letters(own, batch, topic, f"raised-{depth}-{bits}", f"{type(error).__name__}: {error}"[:2000])
            else:
                for half in (bits, bits + 2**depth):
                    self._halve(topic, messages, batch, depth + 1, half)

    def batch(self, messages: DataFrame, batch: int) -> None:
        """One micro-batch, as foreachBatch calls it."""
        failed: list[Exception] = []
        messages = messages.persist()
        try:
            for topic in self.topics:
                if self.files.exists(f"{self.path}/applied/{topic}/{batch}"):
                    continue
                own = messages.where(F.col("topic") == topic)
                try:
                    self._process(topic, own, batch)
                except Exception as error:  # noqa: BLE001  the other topics go on
                    self.files.claim(f"{self.path}/attempts/{topic}/{batch}")
                    if self.attempts(topic, batch) < ATTEMPTS:
                        failed.append(error)
                        continue
                    self._halve(topic, own, batch)
                self.files.create(f"{self.path}/applied/{topic}/{batch}", replace=True)
        finally:
            messages.unpersist()
        if failed:
            raise failed[0]

    def start(self, stream: DataFrame, **trigger) -> StreamingQuery:
        return stream.writeStream.foreachBatch(self.batch).option("checkpointLocation", f"{self.path}/checkpoint").trigger(**(trigger or {"availableNow": True})).start()


def notify(rows: DataFrame, version: int, send: Callable[[DataFrame], None]) -> None:
    """Hand the messages about changed rows to a sink."""
    send(changes.notices(rows, version))
