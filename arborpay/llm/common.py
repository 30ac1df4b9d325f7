"""What several operators share: tables in the shared folder, dropped ids, connected components."""

from __future__ import annotations

import atexit
import gc
import uuid

from pyspark.sql import DataFrame, SparkSession
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

    def table(self, df: DataFrame, name: str = "t", partition_by: tuple[str, ...] = (), codec: str = "snappy") -> DataFrame:
        """Write df once and read it back: cuts the lineage, and every reader sees the same rows."""
        path = self.folder(name)
        schema = df.schema
        df.write.option("compression", codec).partitionBy(*partition_by).parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def settle(self) -> None:
        """Let the driver forget jobs that are done: Spark then deletes their shuffle files on all executors."""
        gc.collect()
        self.spark._jvm.java.lang.System.gc()

    def drop(self, *names: str) -> None:
        """Delete the tables of these names; nothing may read them afterwards."""
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if fs.exists(root):
            for status in fs.listStatus(root):
                if status.getPath().getName().partition("-")[2] in names:
                    fs.delete(status.getPath(), True)


#: Ids up to which a set of ids is broadcast; a larger one is joined by a shuffle.
BROADCAST_IDS = 2_000_000


def _by_ids(ws: Workspace, docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    ids = ws.table(ids.where("doc_id is not null").distinct(), "ids")
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", how)


def without_ids(ws: Workspace, docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id isn't among ids (one column, doc_id); rows without doc_id stay."""
    return _by_ids(ws, docs, ids, "left_anti")


def only_ids(ws: Workspace, docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id is among ids (one column, doc_id); up to BROADCAST_IDS ids, no text is shuffled."""
    return _by_ids(ws, docs, ids, "left_semi")


def connected_components(ws: Workspace, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(v, root): each vertex that an edge names, and the smallest vertex it is connected with.

    Contraction: every vertex points to its smallest neighbour, pointers are followed to their
    ends, and edges move to those ends; what is left is a graph of at most half the vertices.
    Vertices with very many edges only meet as keys of plain joins, which Spark can split.
    """
    spark = ws.spark
    edges = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b")
    edges = ws.table(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    maps = []
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        p = ws.table(both.groupBy(F.col("a").alias("v")).agg(F.least(F.col("v"), F.min("b")).alias("p")), "cc-parent")
        while True:
            up = p.select(F.col("v").alias("u"), F.col("p").alias("q"))
            up2 = up.select(F.col("u").alias("u2"), F.col("q").alias("q2"))
            jumped = p.join(up, p["p"] == up["u"]).join(up2, F.col("q") == up2["u2"]).select("v", F.col("q2").alias("p"), (F.col("p") != F.col("q2")).alias("moved"))
            jumped = ws.table(jumped, "cc-parent")
            p = jumped.select("v", "p")
            if jumped.where("moved").isEmpty():
                break
        maps.append(p)
        pa = p.select(F.col("v").alias("a"), F.col("p").alias("ra"))
        pb = p.select(F.col("v").alias("b"), F.col("p").alias("rb"))
        moved = edges.join(pa, "a").join(pb, "b").where("ra <> rb")
        edges = ws.table(moved.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "cc-edges")
    if not maps:
        return spark.createDataFrame([], "v long, root long")
    out = maps[0].select("v", F.col("p").alias("root"))
    for p in maps[1:]:
        out = out.join(p.select(F.col("v").alias("root"), "p"), "root", "left").select("v", F.coalesce("p", "root").alias("root"))
    return out
