"""Mixing sources to target weights by hierarchical budgets, in DataFrame operations only.

A token budget goes down a tree of domains, languages and sources by weight. A child never gets more
than its documents hold over the allowed epochs; what it can't take goes to its siblings by weight, and
only what a whole family can't take goes to its parent's siblings. A leaf's quota is filled by whole
epochs and then the prefix of one more, in an order seeded by epoch and document. All budgets are
integers, so the result is the same on any cluster.

Only document counts by leaf and by slice of the seeded order are gathered; no leaf is ever sorted as a whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborpay.llm.common import Workspace

LEVELS = ("domain", "lang", "source")
#: Rows of a slice of a leaf's order that one task sorts, on average; leaves up to which thresholds are broadcast.
SLICE_ROWS, BROADCAST_LEAVES = 20_000, 10_000


def word_count(text: Column) -> Column:
    """Words between white space (bytes 20 and 09 to 0D); 0 for null."""
    return F.coalesce(F.size(F.filter(F.split(text, "[ \\t-\\r]+"), lambda w: w != "")), F.lit(0)).cast("long")


def domain_of(source: Column) -> Column:
    """The domain of a source, from the last digit of its name; a null source has its own."""
    digit = F.right(source, F.lit(1))
    return F.when(digit.isin("0", "1", "2", "3"), "web").when(digit.isin("4", "5", "6"), "books").when(source.isNull(), "none").otherwise("code")


def _filled(children: DataFrame, parents: list[str], key: str) -> DataFrame:
    """Share each parent's ``budget`` among its children (``cap``, ``weight``): the water level rises until it is used up."""
    # In order of cap per weight, those under the water level come first.
    turn = Window.partitionBy(*parents).orderBy(F.try_divide("cap", "weight").asc_nulls_last(), key)
    before = F.coalesce(F.sum("cap").over(turn.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(turn.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = children.withColumn("_left", F.col("budget") - before).withColumn("_rest", rest)
    rows = rows.withColumn("_full", (F.col("weight") > 0) & (F.col("cap") * F.col("_rest") <= F.col("_left") * F.col("weight")))
    first = Window.partitionBy(*parents).orderBy("_full", F.try_divide("cap", "weight").asc_nulls_last(), key).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("_l", F.first("_left").over(first)).withColumn("_r", F.first("_rest").over(first))
    share = F.when(F.col("_full"), F.col("cap")).when(F.col("weight") == 0, F.lit(0)).otherwise(F.expr("_l * weight div _r"))
    return rows.withColumn("share", F.greatest(F.lit(0), share).cast("long")).drop("_left", "_rest", "_full", "_l", "_r")


def _named(value: Column) -> Column:
    """The key of a name in the tree; null is a key of its own, which no name has."""
    return F.coalesce(F.concat(F.lit("="), value), F.lit("~"))


def _weight(weights: dict[str, int], key: Column) -> Column:
    if not weights:
        return F.lit(1).cast("long")
    return F.coalesce(F.create_map(*[F.lit(x) for name, w in weights.items() for x in (f"={name}", w)])[key], F.lit(1)).cast("long")


def _leaf(domain: Callable[[Column], Column]) -> dict[str, Column]:
    source = F.col("source").cast("string")
    return {"domain": _named(domain(source)), "lang": _named(F.col("lang").cast("string")), "source": _named(source)}


def _identity() -> Column:
    """What seeds a row's place: its doc_id, or its text where it has none."""
    return F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text-"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))))


def _seeded(seed: int, epoch: Column, identity: Column) -> Column:
    return F.md5(F.concat_ws("-", F.lit(str(seed)), epoch.cast("string"), identity))


def leaf_quotas(meta: DataFrame, weights: dict[str, dict[str, int]], share: float | None, budget: int | None, epochs: int) -> DataFrame:
    """(domain, lang, source, tokens, share): the quota of each leaf. What weighs 0 takes nothing, and neither does anything below it."""

    def off(level: str, cap: Column) -> Column:
        return F.when(_weight(weights.get(level, {}), F.col(level)) == 0, F.lit(0)).otherwise(cap)

    leaves = meta.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")).withColumn("cap", off("source", F.col("tokens") * epochs))
    langs = leaves.groupBy("domain", "lang").agg(F.sum("cap").alias("cap")).withColumn("cap", off("lang", F.col("cap")))
    domains = langs.groupBy("domain").agg(F.sum("cap").alias("cap")).withColumn("cap", off("domain", F.col("cap")))
    root = leaves.agg(F.floor(F.sum("tokens") * F.lit(share)).cast("long").alias("budget")) if budget is None else leaves.limit(1).select(F.lit(budget).cast("long").alias("budget"))
    top = domains.withColumn("weight", _weight(weights.get("domain", {}), F.col("domain"))).withColumn("_root", F.lit(0)).join(root.withColumn("_root", F.lit(0)), "_root")
    top = _filled(top, ["_root"], "domain").select("domain", F.col("share").alias("budget"))
    mid = langs.withColumn("weight", _weight(weights.get("lang", {}), F.col("lang"))).join(top, "domain")
    mid = _filled(mid, ["domain"], "lang").select("domain", "lang", F.col("share").alias("budget"))
    low = leaves.withColumn("weight", _weight(weights.get("source", {}), F.col("source"))).join(mid, ["domain", "lang"])
    return _filled(low, ["domain", "lang"], "source").select(*LEVELS, "tokens", "share")


def mix(docs: DataFrame, weights: dict[str, dict[str, int]], share: float | None = None, budget: int | None = None, epochs: int = 1, seed: int = 9, domain: Callable[[Column], Column] = domain_of) -> DataFrame:
    """docs with columns ``domain`` and ``epoch``: one row for each epoch that takes the document.

    ``weights`` holds whole numbers by level and name; a name that isn't listed weighs 1, so a
    level without weights shares evenly; what weighs 0 is switched off, and the others take its share. The budget is a number of words, or ``share`` of all
    words. ``docs`` needs doc_id, text, lang and source, and keeps all its columns (one named domain or
    epoch is replaced); ``domain`` gives a source's domain. Nulls in lang and source are leaves of their own.
    A null text has no words. A leaf without words is never taken. Rows with the same doc_id go
    together, and so do rows without one that have the same text. No rows give no rows.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "mixing")
    meta = docs.select(_identity().alias("id"), *[c.alias(n) for n, c in _leaf(domain).items()], word_count(F.col("text")).alias("n_tokens"))
    meta = ws.table(meta, "meta")
    quotas = ws.table(leaf_quotas(meta, weights, share, budget, epochs), "quotas")
    few = quotas.count() <= BROADCAST_LEAVES
    whole = F.when(F.col("tokens") > 0, F.expr("share div tokens")).otherwise(F.lit(0))
    quotas = quotas.withColumn("full", whole.cast("int")).withColumn("rest", F.col("share") - F.col("full") * F.col("tokens"))
    hint = F.broadcast if few else (lambda df: df)

    # The cut of the last epoch: first the slice of the order it falls in, then its place there.
    n, digits = meta.count(), 1
    while n > SLICE_ROWS * 16**digits and digits < 8:
        digits += 1
    last = meta.join(hint(quotas.where("rest > 0")), list(LEVELS)).withColumn("h", _seeded(seed, F.col("full") + 1, F.col("id")))
    last = last.select(*LEVELS, "n_tokens", "rest", "h", F.substring("h", 1, digits).alias("slice"))
    up_to = Window.partitionBy(*LEVELS).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = last.groupBy(*LEVELS, "rest", "slice").agg(F.sum("n_tokens").alias("n")).withColumn("ahead", F.coalesce(F.sum("n").over(up_to), F.lit(0)))
    cut = slices.where("ahead <= rest and ahead + n > rest").select(*LEVELS, "slice", "ahead")
    cut = ws.table(cut, "cuts")
    inside = last.join(hint(cut), [*LEVELS, "slice"])
    running = Window.partitionBy(*LEVELS).orderBy("h").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("upto", F.col("ahead") + F.sum("n_tokens").over(running)).where("upto <= rest")
    inside = inside.groupBy(*LEVELS).agg(F.max("h").alias("h_in"))
    limits = cut.join(inside, list(LEVELS), "left").select(*LEVELS, F.coalesce("h_in", "slice").alias("h_max"))
    limits = ws.table(quotas.join(limits, list(LEVELS), "left").select(F.struct(*LEVELS).alias("leaf"), F.col("full"), F.col("h_max")), "limits")

    # The caller's columns stay in one struct, so that none can clash with those of the tree.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.struct(*[c.alias(n) for n, c in _leaf(domain).items()]).alias("leaf"), _identity().alias("id"), domain(F.col("source").cast("string")).alias("domain"))
    rows = rows.join(hint(limits), "leaf")
    partial = F.coalesce(_seeded(seed, F.col("full") + 1, F.col("id")) <= F.col("h_max"), F.lit(False))
    taken = F.col("full") + partial.cast("int")
    rows = rows.select("doc", "domain", F.explode(F.when(taken > 0, F.sequence(F.lit(1), taken)).otherwise(F.array().cast("array<int>"))).alias("epoch"))
    return rows.select(*[F.col("doc")[c].alias(c) for c in docs.columns if c not in ("domain", "epoch")], "domain", "epoch")
