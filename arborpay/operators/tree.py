"""Trees of members as DataFrames (user_id, parent_id): depths, ancestors, closures, nearest ancestors and folds.

Upward questions are answered by pointer doubling, in as many rounds as the depth has bits. Folds go
level by level over a table partitioned by depth, so each row is read once and the work is linear.

Members' tables are joined by merge, here and in all of the settlement: dense ids compress to next to nothing,
so Spark would take a table of millions of members for a small one by its files and send it through the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborpay.sources.workspace import Workspace

#: The parent of a root.
ROOT = -1
#: Rounds of doubling (depth up to 2**ROUNDS), and levels of a closure, beyond which input is taken for a cycle.
ROUNDS, LEVELS = 40, 5000
#: Name of the folders of a table that is written step by step.
STEP = "step"


class TreeError(ValueError):
    """The edges don't form a forest under the root."""


def with_key(rows: DataFrame, name: str = "_up") -> DataFrame:
    """rows with ``up`` as a join key under another name; members that are at the root, who meet nobody, are dealt over all tasks."""
    return rows.withColumn(name, F.when(F.col("up") == ROOT, F.bitwise_not("user_id")).otherwise(F.col("up")))


#: Spellings of "no parent" that no member has as its id. Where no member is called 0, sources spell it "0" as well.
NO_PARENT, ZERO = ("0.0", "", "<NA>", "None", "nan", "NaN", str(ROOT)), ("0",)


def without_roots(edges: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """Edges between members; the spellings of "no parent" that occur in sources count as the root, ``also`` more of them."""
    return edges.where(F.col("parent_id").isNotNull() & ~F.col("parent_id").cast("string").isin(*NO_PARENT, *also))


def rooted(edges: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """edges with one root, ROOT, for every spelling of "no parent"."""
    parent = F.col("parent_id").cast("string")
    none = F.coalesce(parent.isin(*NO_PARENT, *also), F.lit(True))
    return edges.withColumn("parent_id", F.when(none, F.lit(ROOT)).otherwise(F.expr("try_cast(parent_id as bigint)")).cast("long"))


def reached(ws: Workspace, edges: DataFrame) -> DataFrame:
    """(user_id) of the members from which the root is reached. Orphans, and members of a cycle or below one, aren't.

    By doubling: after as many rounds as the number of members has bits, every path that ends has ended.
    """
    hops, n = ws.counted(edges.select("user_id", F.col("parent_id").alias("up")), "reached")
    for _ in range(n.bit_length()):
        over = hops.select(F.col("user_id").alias("up"), F.col("up").alias("up2"))
        done, rest = hops.where(F.col("up") == ROOT), hops.where(F.col("up") != ROOT)
        hops, left = ws.counted(done.unionByName(rest.join(over.hint("merge"), "up").select("user_id", F.col("up2").alias("up"))), "reached", f"up <> {ROOT}")
        if not left:
            break
    return hops.where(F.col("up") == ROOT).select("user_id").distinct()


def depths(ws: Workspace, edges: DataFrame) -> DataFrame:
    """edges with ``depth``, 0 for children of ROOT; edges that have it stay. Orphans and cycles raise TreeError."""
    if "depth" in edges.columns:
        return edges
    hops, left = ws.counted(edges.select("user_id", F.col("parent_id").alias("up"), F.lit(0).alias("hops")), "depths", f"up <> {ROOT}")
    for _ in range(left.bit_length() + 2):  # a path that ends has ended by then
        if not left:
            return edges.join(hops.select("user_id", F.col("hops").alias("depth")).hint("merge"), "user_id")
        over = hops.select(F.col("user_id").alias("up"), F.col("up").alias("up2"), F.col("hops").alias("hops2"))
        done, rest = hops.where(F.col("up") == ROOT), hops.where(F.col("up") != ROOT)
        moved = rest.join(over.hint("merge"), "up", "left")
        moved = moved.select("user_id", F.coalesce("up2", F.lit(-2)).alias("up"), (F.col("hops") + 1 + F.coalesce("hops2", F.lit(0))).cast("int").alias("hops"))
        hops, left = ws.counted(done.unionByName(moved), "depths", f"up <> {ROOT}")
        if left and not hops.where("up = -2").isEmpty():
            raise TreeError(f"no path to the root, for example of {[r[0] for r in hops.where('up = -2').limit(5).collect()]}")
    raise TreeError("a cycle: depths don't settle")


def subtree_sums(ws: Workspace, edges: DataFrame, values: list[str]) -> DataFrame:
    """edges with each of ``values`` (long columns) summed over the member's subtree, itself included.

    By doubling: after round k a member holds the sums over descendants less than 2**k below it, and
    gives them to its ancestor 2**k above. As many rounds as the depth has bits.
    """
    rows, left = ws.counted(edges.select("user_id", F.col("parent_id").alias("up"), *values), "sums", f"up <> {ROOT}")
    for _ in range(ROUNDS):
        if not left:
            return edges.drop(*values).join(rows.drop("up").hint("merge"), "user_id")
        given = rows.where(F.col("up") != ROOT).groupBy(F.col("up").alias("user_id")).agg(*[F.sum(v).alias(f"_{v}") for v in values])
        over = rows.select(F.col("user_id").alias("_up"), F.col("up").alias("up2"))
        moved = with_key(rows.join(given.hint("merge"), "user_id", "left")).join(over.hint("merge"), "_up", "left")
        moved = moved.select("user_id", F.when(F.col("up") == ROOT, F.lit(ROOT)).otherwise(F.coalesce("up2", F.lit(ROOT))).alias("up"), *[(F.col(v) + F.coalesce(f"_{v}", F.lit(0))).alias(v) for v in values])
        rows, left = ws.counted(moved, "sums", f"up <> {ROOT}")
    raise TreeError("a cycle: sums don't settle")


def nearest(ws: Workspace, edges: DataFrame, wanted: DataFrame, itself: bool = False) -> DataFrame:
    """(user_id, nearest): the closest ancestor among ``wanted`` (user_id), or ROOT; with ``itself``, a member counts as its own."""
    marks = wanted.select("user_id", F.lit(True).alias("hit")).distinct()
    base = edges.join(marks.hint("merge"), "user_id", "left")
    hop = ws.table(base.select("user_id", F.col("parent_id").alias("up"), F.coalesce("hit", F.lit(False)).alias("hit"), F.lit(True).alias("moved")), "nearest")
    for _ in range(ROUNDS):
        over = hop.select(F.col("user_id").alias("_up"), F.col("up").alias("up2"), F.col("hit").alias("stop"))
        go_on = ~F.coalesce("stop", F.lit(True)) & (F.col("up") != ROOT)
        rest, done = hop.where("moved"), hop.where("not moved")  # who has arrived stays, and would only crowd a key
        moved = with_key(rest).join(over.hint("merge"), "_up", "left").select("user_id", F.when(go_on, F.col("up2")).otherwise(F.col("up")).alias("up"), "hit", go_on.alias("moved"))
        hop, left = ws.counted(done.unionByName(moved), "nearest", "moved")
        if not left:
            own = F.when(F.col("hit"), F.col("user_id")) if itself else F.lit(None)
            return hop.select("user_id", F.coalesce(own, F.col("up")).alias("nearest"))
    raise TreeError("a cycle: nearest ancestors don't settle")


def rounds(ws: Workspace, front: DataFrame, step: Callable[[DataFrame, int], DataFrame], name: str, most: int = LEVELS) -> DataFrame:
    """All rows of a frontier and of what a step makes of it, round by round, until none are left.

    Rounds are folders of one table, so the result is one scan, however many there are.
    """
    path, schema, n = ws.folder(name), None, 0
    while True:
        at = f"{path}/{STEP}={n}"
        front, left = ws.counted_at(front, at)
        schema = schema or front.schema
        n += 1
        if not left:
            return ws.spark.read.schema(schema).parquet(*[f"{path}/{STEP}={k}" for k in range(n)])
        if n > most:
            raise TreeError(f"paths of more than {most} steps")
        front = step(front, n)


def closure(ws: Workspace, edges: DataFrame, carry: tuple[str, ...] = (), levels: int = LEVELS) -> DataFrame:
    """(ancestor, descendant, level, *carry): every pair on a path, ROOT excluded.

    ``carry`` names columns of the edge just below the ancestor, for example the leg. A pair that is
    reached twice, a path of more than ``levels`` steps, or a carried leg other than 1 and 2 raises TreeError.
    """
    steps = ws.table(without_roots(edges).select("user_id", "parent_id", *carry), "closure-edges")
    if "leg" in carry:
        wrong = steps.where("leg is null or leg not in (1, 2)").limit(20).collect()
        if wrong:
            raise TreeError(f"members on no leg: {[r['user_id'] for r in wrong]}")
    up = steps.select(F.col("user_id").alias("ancestor"), F.col("parent_id"), *[F.col(c).alias(f"up_{c}") for c in carry])

    def step(front: DataFrame, _: int) -> DataFrame:
        return front.join(up.hint("merge"), "ancestor").select(F.col("parent_id").alias("ancestor"), "descendant", (F.col("level") + 1).alias("level"), *[F.col(f"up_{c}").alias(c) for c in carry])

    first = steps.select(F.col("parent_id").alias("ancestor"), F.col("user_id").alias("descendant"), F.lit(1).alias("level"), *carry)
    out = rounds(ws, first, step, "closure", levels)
    twice = out.groupBy("ancestor", "descendant").count().where("count > 1").limit(20).collect()
    if twice:
        raise TreeError(f"members reached by several paths: {[(r[0], r[1]) for r in twice]}")
    return out


def ancestors(ws: Workspace, edges: DataFrame, members: DataFrame) -> DataFrame:
    """(descendant, ancestor, level) of the given members (user_id) only: the frontier starts at them."""
    steps = ws.table(without_roots(edges).select("user_id", "parent_id"), "ancestor-edges")
    up = steps.withColumnRenamed("user_id", "ancestor")
    first = steps.join(members.select("user_id").distinct().hint("merge"), "user_id", "left_semi").select(F.col("user_id").alias("descendant"), F.col("parent_id").alias("ancestor"), F.lit(1).alias("level"))
    return rounds(ws, first, lambda front, _: front.join(up.hint("merge"), "ancestor").select("descendant", F.col("parent_id").alias("ancestor"), (F.col("level") + 1).alias("level")), "ancestors")


def descendant_counts(with_depth: DataFrame) -> DataFrame:
    """(level, n) of all members under the root, by generation."""
    return with_depth.groupBy(F.col("depth").alias("level")).agg(F.count("*").alias("n"))


def descendants(ws: Workspace, edges: DataFrame, members: DataFrame, deepest: int = LEVELS) -> DataFrame:
    """(ancestor, descendant, level) below the given members (user_id), to a depth at most; themselves excluded."""
    down = ws.table(without_roots(edges).select(F.col("parent_id").alias("descendant"), F.col("user_id").alias("child")), "descendant-edges")
    first = members.select(F.col("user_id").alias("ancestor")).distinct().join(down.withColumnRenamed("descendant", "ancestor").hint("merge"), "ancestor").select("ancestor", F.col("child").alias("descendant"), F.lit(1).alias("level"))

    def step(front: DataFrame, _: int) -> DataFrame:
        below = front.where(F.col("level") < deepest).join(down.hint("merge"), "descendant")
        return below.select("ancestor", F.col("child").alias("descendant"), (F.col("level") + 1).alias("level"))

    return rounds(ws, first.where(F.lit(deepest) > 0), step, "descendants")


def children(edges: DataFrame, parents: DataFrame) -> DataFrame:
    """(parent_id, children): direct children of the given members, in order."""
    kept = edges.join(parents.select(F.col("user_id").alias("parent_id")).distinct().hint("merge"), "parent_id", "left_semi")
    return kept.groupBy("parent_id").agg(F.sort_array(F.collect_list("user_id")).alias("children"))


def page(df: DataFrame, key: str | tuple[str, ...], cursor, size: int) -> DataFrame:
    """The next rows after a cursor, one more than asked for to show that there are more.

    With several keys (depth and member, or parent and member) the cursor is a tuple, and rows go in their order.
    """
    keys = (key,) if isinstance(key, str) else key
    at = (cursor,) if isinstance(key, str) else cursor
    rows = df if cursor is None else df.where(F.struct(*keys) > F.struct(*[F.lit(x).alias(k) for k, x in zip(keys, at, strict=True)]))
    return rows.orderBy(*keys).limit(size + 1)


#: Levels from which a fold goes by heavy paths, where its rule is known for one member as well.
DEEP = 48


def fold(ws: Workspace, nodes: DataFrame, gives: dict[str, tuple[Column, str]], takes: Callable[[DataFrame], DataFrame], rule: "paths.Rule | None" = None) -> DataFrame:
    """Fold a forest from its leaves up.

    ``nodes`` has user_id, parent_id, depth and own columns. For each level, from the deepest,
    ``gives`` (name: aggregate, type) sums up the finished rows of the level below by parent, and
    ``takes`` finishes the rows of the level from their own and these columns, which are null where no
    child gave anything. Levels are folders of one table, so the result is one scan. A level is a job;
    where a ``rule`` says the same of one member, a tree of DEEP levels or more is folded by heavy paths.
    """
    schema = nodes.schema
    top = nodes.agg(F.max("depth")).first()[0]
    if rule is not None and top is not None and top >= DEEP:
        blank = nodes.select("*", *[F.lit(None).cast(kind).alias(name) for name, (_, kind) in gives.items()])
        return paths.fold(ws, ws.table(nodes, "fold-nodes"), gives, takes(blank).schema, rule)
    nodes = ws.table(nodes, "fold-nodes", partition_by=("depth",)).select(schema.names)
    path, below = ws.folder("fold"), None
    for depth in range(0 if top is None else top, -1, -1):
        level = nodes.where(F.col("depth") == depth)
        if below is not None:
            given = below.groupBy(F.col("parent_id").alias("user_id")).agg(*[x.cast(kind).alias(name) for name, (x, kind) in gives.items()])
            level = level.join(given.hint("merge"), "user_id", "left")
        else:
            level = level.select("*", *[F.lit(None).cast(kind).alias(name) for name, (_, kind) in gives.items()])
        below = ws.table_at(takes(level), f"{path}/{STEP}={depth}")
    return ws.spark.read.schema(below.schema).parquet(*[f"{path}/{STEP}={k}" for k in range(0 if top is None else top, -1, -1)])


from arborpay.operators import paths  # noqa: E402  it builds on this module
