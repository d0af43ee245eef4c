"""Mixing sources to target weights by hierarchical budgeting.

Documents hang in a tree of domains, languages and sources.  A token budget
enters at the root and each node splits its share among its children by weight.
A child cannot take more than its documents give in ``max_epochs`` rounds; what
it leaves goes to its siblings by weight, and only what no sibling can take
returns to the parent's siblings.  Splitting top down with capped shares does
this: a node is never given more than its subtree can hold, so every shortage is
made good at the lowest level that can.  Within a family the shares are
``min(capacity, level * weight)``, with the level found by running sums over
the children in order of capacity per weight.

A leaf's stream is its documents in seeded order, a new order each epoch.  The
leaf takes the prefix of exactly its budget: whole epochs, then documents by
running tokens, the last one in part (``take_tokens``).  The running sum never
sees a whole leaf: the order is cut in about the square root of its rows many
bins, bins are summed with map-side combine, and only the bin with the end
of the prefix is sorted.

Tokens are words.  A null or unknown value of a level counts as ``(none)``; a
value without a weight gets the least weight listed for its level, 1 where none
is listed; weights of 0 or less take nothing.  Null and empty texts have no
tokens and are never taken.  Repeated rows are each of them rows of the stream;
ties of the order are rows that are equal in id and text, so any of them may
come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageloom.sources import scratch

LEVELS = ("domain", "lang", "source")
BUDGET_SHARE = 0.8
MAX_EPOCHS = 2
SEED = 3
NONE = "(none)"
WORD = r"[^\x20\x09-\x0D]+"

Weights = dict[str, dict[str, float]]


def _weight(level: str, weights: Weights) -> Column:
    listed = weights.get(level, {})
    if not listed:
        return F.lit(1.0)
    table = F.create_map(*[F.lit(x) for name, w in listed.items() for x in (name, float(w))])
    return F.coalesce(F.element_at(table, F.col(level)), F.lit(float(min(listed.values()))))


def budgets(leaves: DataFrame, levels: tuple[str, ...], weights: Weights, budget: float, max_epochs: int) -> DataFrame:
    """Adds ``target`` (tokens, whole) to leaves ``(*levels, tokens, n)``."""
    holds = F.col("tokens") * F.lit(float(max_epochs))
    for level in levels:
        holds = F.when(_weight(level, weights) > 0, holds).otherwise(0.0)
    tree = leaves.withColumn("holds", holds)
    given = tree.agg(F.least(F.lit(float(budget)), F.coalesce(F.sum("holds"), F.lit(0.0))).alias("given"))
    for depth, level in enumerate(levels):
        parent, path = list(levels[:depth]), list(levels[: depth + 1])
        nodes = tree.groupBy(*path).agg(F.sum("holds").alias("holds")).withColumn("w", F.greatest(_weight(level, weights), F.lit(0.0)))
        nodes = nodes.join(given, parent) if parent else nodes.join(F.broadcast(given))  # the root is one row
        order = Window.partitionBy(*parent).orderBy(F.when(F.col("w") > 0, F.col("holds") / F.col("w")).otherwise(float("inf")), level)
        family = Window.partitionBy(*parent)
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        rest = F.sum("w").over(family) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
        nodes = nodes.withColumn("line", F.when(rest > 0, (F.col("given") - F.coalesce(F.sum("holds").over(before), F.lit(0.0))) / rest).otherwise(0.0))
        nodes = nodes.withColumn("fills", F.col("holds") <= F.col("line") * F.col("w"))
        line = F.max(F.when(~F.col("fills"), F.col("line"))).over(family)
        share = F.when(F.col("fills"), F.col("holds")).otherwise(F.least(F.col("holds"), line * F.col("w")))
        given = nodes.select(*path, share.alias("given"))
    return tree.join(given, list(levels)).select(*levels, "tokens", "n", F.floor(F.col("given") + 1e-6).alias("target"))


def _order(epoch: Column, seed: int) -> Column:
    """Place in the order of an epoch: 63 seeded bits."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), epoch, F.col("doc_id"), F.col("text_hash")), 1)


def mix(
    docs: DataFrame, weights: Weights, levels: tuple[str, ...] = LEVELS, budget_share: float = BUDGET_SHARE,
    max_epochs: int = MAX_EPOCHS, seed: int = SEED, carry: tuple[str, ...] = (),
) -> DataFrame:
    """``(doc_id, *levels, epoch, n_tokens, take_tokens)`` of the rows taken, and carried columns in ``row``.

    The budget is ``budget_share`` of all tokens.  A row appears once for each
    epoch that takes it.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), *[F.coalesce(F.col(c).cast("string"), F.lit(NONE)).alias(c) for c in levels],
        F.xxhash64(text).alias("text_hash"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_tokens"),
        *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")] if carry else []),
    )
    rows = scratch.materialise(rows, "mix-rows").filter("n_tokens > 0")
    leaves = scratch.materialise(rows.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n")), "leaves")
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    plan = budgets(leaves, levels, weights, budget_share * total, max_epochs)
    plan = plan.withColumn("whole", F.floor(F.col("target") / F.col("tokens")).cast("int"))
    plan = plan.withColumn("rest", F.col("target") - F.col("whole") * F.col("tokens")).withColumn("bits", F.ceil(F.log2(F.sqrt("n"))).cast("int"))
    plan = scratch.materialise(plan, "plan")

    keys = list(levels)
    placed = rows.join(plan, keys).withColumn("place", _order(F.col("whole"), seed)).withColumn("bin", F.expr("shiftright(place, 63 - bits)"))
    binned = placed.filter("rest > 0").groupBy(*keys, "bin", "rest").agg(F.sum("n_tokens").alias("held"))
    run = Window.partitionBy(*keys).orderBy("bin")
    ends = binned.withColumn("before", F.sum("held").over(run) - F.col("held"))
    cut = ends.filter("before < rest and before + held >= rest").select(*keys, F.col("bin").alias("cut"), "before")
    cut = scratch.materialise(cut, "cut")

    out = [*[F.col(c) for c in ("doc_id", *levels)], F.col("epoch"), F.col("n_tokens"), F.col("take_tokens").cast("long").alias("take_tokens"), *([F.col("row")] if carry else [])]
    whole = placed.filter("whole > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("whole") - 1))).withColumn("take_tokens", F.col("n_tokens"))
    part = placed.join(cut, keys).withColumn("epoch", F.col("whole"))
    inside = part.filter("bin < cut").withColumn("take_tokens", F.col("n_tokens"))
    run = Window.partitionBy(*keys).orderBy("place", "doc_id", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    edge = part.filter("bin = cut").withColumn("left", F.col("rest") - F.col("before") - F.coalesce(F.sum("n_tokens").over(run), F.lit(0)))
    edge = edge.filter("left > 0").withColumn("take_tokens", F.least("left", "n_tokens"))
    return whole.select(*out).unionAll(inside.select(*out)).unionAll(edge.select(*out))
