"""Written tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session, or a local one where it is unset (tests)."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if "dir" not in _OWN:
        import shutil
        import tempfile

        _OWN["dir"] = tempfile.mkdtemp(prefix="arborpay-")
        atexit.register(shutil.rmtree, _OWN["dir"], ignore_errors=True)
    return "file://" + _OWN["dir"]


class Workspace:
    """Written tables of one run, under one folder of the shared directory."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0

    def folder(self, name: str) -> str:
        self.count += 1
        return f"{self.path}/{self.count:03d}-{name}"

    def table(self, df: DataFrame, name: str = "t", partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Write df once and read it back: cuts the lineage, and every reader sees the same rows."""
        return self.table_at(df, self.folder(name), partition_by)

    def table_at(self, df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """As table(), at a place of its own."""
        schema = df.schema
        df.write.partitionBy(*partition_by).parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def counted(self, df: DataFrame, name: str, condition: str = "true") -> tuple[DataFrame, int]:
        """As table(), with the number of rows that meet a condition, taken while writing."""
        return self.counted_at(df, self.folder(name), condition)

    def counted_at(self, df: DataFrame, path: str, condition: str = "true") -> tuple[DataFrame, int]:
        """As counted(), at a place of its own."""
        seen = Observation()
        out = self.table_at(df.observe(seen, F.count_if(F.expr(condition)).alias("n")), path)
        return out, seen.get["n"]

    def drop(self, *names: str) -> None:
        """Delete the tables of these names; nothing may read them afterwards."""
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if fs.exists(root):
            for status in fs.listStatus(root):
                if status.getPath().getName().partition("-")[2] in names:
                    fs.delete(status.getPath(), True)
