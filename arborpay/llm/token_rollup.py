"""Token counts as rollups that signed deltas maintain.

A batch of changes (documents inserted, deleted or counted anew) becomes one signed delta per source,
language and tokenizer version, so totals are plain sums and never need the documents again. A batch
is committed by a marker file that names its written deltas. A marker is written aside and renamed, so
it is there whole or not at all; a batch that is applied again, or retried after a lost driver, counts once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborpay.llm.tokens import count_column

KEYS = ("source", "lang", "tokenizer_version")
SCHEMA = "source string, lang string, tokenizer_version string, n_docs long, n_tokens long"


def inserted(counts: DataFrame) -> DataFrame:
    """Changes that add documents: counts has the keys and n_tokens."""
    return counts.select(*KEYS, F.lit(1).cast("long").alias("n_docs"), F.col("n_tokens").cast("long").alias("n_tokens"))


def deleted(counts: DataFrame) -> DataFrame:
    """Changes that take documents away, with the counts they had."""
    return counts.select(*KEYS, F.lit(-1).cast("long").alias("n_docs"), (-F.col("n_tokens")).cast("long").alias("n_tokens"))


def revised(counts: DataFrame) -> DataFrame:
    """Changes of counts: counts has old_tokens and n_tokens."""
    return counts.select(*KEYS, F.lit(0).cast("long").alias("n_docs"), (F.coalesce("n_tokens", F.lit(0)) - F.coalesce("old_tokens", F.lit(0))).cast("long").alias("n_tokens"))


def token_counts(docs: DataFrame, vocabularies: tuple[str, ...]) -> DataFrame:
    """(doc_id, source, lang, tokenizer_version, n_tokens): a row per document and vocabulary.

    ``docs`` needs doc_id, source, lang and text; other columns are not read. A null or empty text has
    no tokens. Repeated rows each count. No rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.slice(at, 1024)
                for name in vocabularies:
                    version = pa.array([name.rpartition("/")[2].rpartition(".")[0]] * len(part), pa.string())
                    yield pa.RecordBatch.from_arrays([*part.columns[:3], version, pa.array(list(count_column(part.column(3), name)), pa.int64())], ["doc_id", "source", "lang", "tokenizer_version", "n_tokens"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c).cast("string").alias(c) for c in ("source", "lang", "text")])
    return plain.mapInArrow(run, "doc_id long, source string, lang string, tokenizer_version string, n_tokens long")


class TokenRollup:
    """Rollups under one folder: deltas/<attempt> tables, and a marker per committed batch.

    Null keys are groups of their own and null counts count as 0. A batch without rows commits nothing but
    its marker. A group whose documents and tokens both come to 0 is left out of the totals.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._root = self._hadoop.Path(path)
        self._fs = self._root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _markers(self) -> list[dict]:
        """What is committed: {batch, table, covers}; a compaction has a name in place of a batch, and covers batches."""
        folder = self._hadoop.Path(f"{self.path}/commits")
        if not self._fs.exists(folder):
            return []
        rows = self.spark.read.text(f"{self.path}/commits").collect()  # one line per batch
        return [json.loads(r[0]) for r in rows]

    def _commit(self, name: str, entry: dict) -> bool:
        path, aside = self._hadoop.Path(f"{self.path}/commits/{name}.json"), self._hadoop.Path(f"{self.path}/aside/{uuid.uuid4().hex}")
        if self._fs.exists(path):
            if self._fs.getFileStatus(path).getLen():
                return False
            self._fs.delete(path, False)  # an empty file commits nothing
        stream = self._fs.create(aside, False)
        try:
            stream.write(bytearray((json.dumps(entry) + "\n").encode()))
        finally:
            stream.close()
        self._fs.mkdirs(path.getParent())
        if not self._fs.rename(aside, path) and not self._fs.exists(path):
            raise OSError(f"{path} can't be written")
        return name in self._names()

    def _names(self) -> set[str]:
        return {f"batch-{m['batch']}" if m["batch"] else m["name"] for m in self._markers()}

    def committed(self) -> set[str]:
        """Ids of the batches in the totals."""
        return {b for m in self._markers() for b in [m["batch"], *m["covers"]] if b}

    def apply(self, batch: str, *changes: DataFrame) -> bool:
        """Commit the changes as one batch; False if it was committed before, and then nothing happens."""
        if not batch.replace("-", "").replace("_", "").isalnum():
            raise ValueError(f"not a batch id: {batch!r}")
        if batch in self.committed():
            return False
        table = f"deltas/{batch}-{uuid.uuid4().hex}"
        rows = changes[0]
        for more in changes[1:]:
            rows = rows.unionByName(more)
        deltas = rows.groupBy(*KEYS).agg(F.sum(F.coalesce("n_docs", F.lit(0))).alias("n_docs"), F.sum(F.coalesce("n_tokens", F.lit(0))).alias("n_tokens"))
        deltas.write.parquet(f"{self.path}/{table}")
        return self._commit(f"batch-{batch}", {"batch": batch, "table": table, "covers": []})

    def _tables(self, markers: list[dict]) -> tuple[list[str], list[str]]:
        """The tables that the totals add up, and the batches in them.

        One compaction at most counts, that which covers most, beside the batches it doesn't cover; so
        neither a batch committed meanwhile nor a second compaction can count anything twice.
        """
        bases = [m for m in markers if not m["batch"]]
        base = max(bases, key=lambda m: (len(m["covers"]), m["name"]), default={"covers": [], "table": None})
        covered = set(base["covers"])
        own = {m["batch"]: m["table"] for m in markers if m["batch"] and m["batch"] not in covered}
        return [f"{self.path}/{t}" for t in [base["table"], *own.values()] if t], sorted({*covered, *own})

    def _sums(self, tables: list[str]) -> DataFrame:
        rows = self.spark.read.schema(SCHEMA).parquet(*tables) if tables else self.spark.createDataFrame([], SCHEMA)
        sums = rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return sums.where("n_docs <> 0 or n_tokens <> 0")

    def totals(self) -> DataFrame:
        """Sums of the committed deltas."""
        return self._sums(self._tables(self._markers())[0])

    def compact(self) -> None:
        """Write the totals as one table that stands for the batches committed so far."""
        tables, batches = self._tables(self._markers())
        name = f"base-{uuid.uuid4().hex}"
        self._sums(tables).write.parquet(f"{self.path}/deltas/{name}")
        self._commit(name, {"batch": None, "name": name, "table": f"deltas/{name}", "covers": batches})
