"""Near-duplicate images: leader grouping under two hash distances.

Items arrive in the order of ``ord``.  Each joins the first-created group whose
leader is within ``t`` hexadecimal characters on both hashes, or leads a new
group.  This is the lexicographically first maximal independent set of the
similarity graph, computed by sample and prune: leaders among the earliest
items are settled first, everything they cover leaves, and the next slice is
taken from what is left.  Items are only ever compared with leaders and within
one slice, never with all their copies.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions import fixed
from pageloom.functions.hashes import hex_to_long, nibble_distance
from pageloom.functions.labels import dims_label, size_kb
from pageloom.operators.ranking import with_row_number
from pageloom.sources.scratch import materialise

NIBBLES = 16
# First slice, growth from slice to slice, smallest slice.
FIRST_SLICE = 65_536
GROWTH = 8
SMALLEST_SLICE = 4_096
# A slice is cut when comparing it with itself would cost more than this.
PAIR_BUDGET = 50_000_000
PAIRS_PER_ITEM = 2_000
# Keys of a hash, and rows of one key that are not yet told apart by the other hash.
MOST_KEYS = 64
CROWDED = 2_000


def _cut(t: int) -> tuple[int, list[int]]:
    """How many runs of hash characters agree at least, and the masks of the runs.

    The characters are cut into ``r`` runs.  ``t`` differences touch at most
    ``t`` runs, so all of some ``r - t`` runs agree.  The largest ``r`` with at
    most ``MOST_KEYS`` choices gives the widest keys: 56 of 24 bits at 5.
    """
    r = max(n for n in range(t + 1, NIBBLES + 1) if comb(n, t) <= MOST_KEYS)
    cuts = [NIBBLES * i // r for i in range(r + 1)]
    return r - t, [((1 << 4 * (hi - lo)) - 1) << 4 * (NIBBLES - hi) for lo, hi in zip(cuts, cuts[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _cover(t: int) -> list[int]:
    """Masks of hash characters of which two hashes within ``t`` agree on one at least."""
    agree, runs = _cut(t)
    return [_signed(sum(chosen)) for chosen in combinations(runs, agree)]


def _constant(values: Sequence[int], suffix: str = "") -> str:
    """A list as SQL text: one constant, so that plans and generated code stay small however long it is."""
    return f"array({', '.join(f'{x}{suffix}' for x in values)})"


def _first_shared(x: str, kind: str, t: int) -> Column:
    """Is mask ``kind``, under which the XOR ``x`` of two hashes is zero, the first such mask?

    The masks come in the order of their runs, so it is the first if up to its
    last run no other run agrees.
    """
    agree, runs = _cut(t)
    chosen = list(combinations(range(len(runs)), agree))
    same = " | ".join(f"if({x} & {_signed(m)}L = 0, {1 << i}, 0)" for i, m in enumerate(runs))
    below = _constant([(2 << c[-1]) - 1 for c in chosen])
    wanted = _constant([sum(1 << i for i in c) for c in chosen])
    return F.expr(f"({same}) & get({below}, {kind}) = get({wanted}, {kind})")


def _spread(items: DataFrame, value: str, kind: str, key: str, t: int) -> DataFrame:
    """Items once per mask: its number as ``kind``, the characters of ``value`` under it as ``key``."""
    rows = items.select("*", F.expr(f"posexplode({_constant(_cover(t), 'L')})").alias(kind, "__mask"))
    return rows.withColumn(key, F.col(value).bitwiseAND(F.col("__mask"))).drop("__mask")


def _crowded(items: DataFrame, t: int) -> DataFrame | None:
    """Keys of the perceptual hash that more than ``CROWDED`` of all items share; None if there is none."""
    rows = _spread(items.select("p"), "p", "kind", "key", t)
    keys = materialise(rows.groupBy("kind", "key").agg(F.count("*").alias("c")).filter(F.col("c") > CROWDED).select("kind", "key"), "crowded")
    return None if keys.isEmpty() else keys


def _keyed(items: DataFrame, crowded: DataFrame | None, t: int) -> DataFrame:
    """Items once per key of the perceptual hash, ``(n, p, a, kind, key, a_kind, a_key)``.

    A crowded key, as of images that share a perceptual hash, is split by the
    keys of the average hash.
    """
    rows = _spread(items.select("n", "p", "a"), "p", "kind", "key", t)
    if crowded is None:
        return rows.withColumns({"a_kind": F.lit(-1), "a_key": F.lit(0).cast("long")})
    rows = rows.join(crowded.withColumn("__many", F.lit(True)), ["kind", "key"], "left")
    masks = f"if(__many, {_constant(_cover(t), 'L')}, array(0L))"
    rows = rows.select("*", F.expr(f"posexplode({masks})").alias("__place", "__mask"))
    return rows.select("n", "p", "a", "kind", "key", F.expr("if(__many, __place, -1)").alias("a_kind"), F.expr("a & __mask").alias("a_key"))


def _merged(table: DataFrame) -> DataFrame:
    """For the right side of a join: a table that grows with the items is never gathered in the driver.

    Its size is guessed from compressed files, and before its hashes are put
    under their masks, so that a table of gigabytes can pass for a small one.
    """
    return table.hint("merge")


def _near(left: DataFrame, right: DataFrame, crowded: DataFrame | None, t: int, ordered: bool) -> DataFrame:
    """``(lo, hi)``: rows of ``right`` within ``t`` of rows of ``left``.

    An equi-join on covering keys.  Each pair passes only through the first
    keys it shares, so it comes out once and needs no ``distinct``.
    """
    l, r = _keyed(left, crowded, t).alias("l"), _keyed(right, crowded, t).alias("r")
    px = F.col("l.p").bitwiseXOR(F.col("r.p"))
    ax = F.col("l.a").bitwiseXOR(F.col("r.a"))
    zero = F.lit(0).cast("long")
    hit = (nibble_distance(px, zero) <= t) & (nibble_distance(ax, zero) <= t)
    for c in ("kind", "key", "a_kind", "a_key"):
        hit = hit & (F.col(f"l.{c}") == F.col(f"r.{c}"))
    if ordered:
        hit = hit & (F.col("l.n") < F.col("r.n"))
    pairs = l.join(_merged(r), hit).select(F.col("l.n").alias("lo"), F.col("r.n").alias("hi"), F.col("l.kind"), F.col("l.a_kind"), px.alias("px"), ax.alias("ax"))
    once = _first_shared("px", "kind", t) & ((F.col("a_kind") < 0) | _first_shared("ax", "a_kind", t))
    return pairs.filter(once).select("lo", "hi")


def hashed(items: DataFrame) -> DataFrame:
    """Add the BIGINT copies ``p`` and ``a`` of the hash texts."""
    return items.withColumn("p", hex_to_long(F.col("phash"))).withColumn("a", hex_to_long(F.col("ahash")))


def exact_hash_groups(items: DataFrame) -> DataFrame:
    """Items with identical hashes: their number and the first of them."""
    return items.groupBy("phash", "ahash").agg(F.count("*").alias("n_items"), F.min("ord").alias("first_ord"))


def similar_pairs(items: DataFrame, leaders: DataFrame, t: int = fixed.SIMILARITY_THRESHOLD) -> DataFrame:
    """``(ord, leader_ord)``: items and the leaders within ``t`` of them on both hashes.

    Distinct hashes are compared, items come back by an equi-join.
    """
    if t >= NIBBLES:
        raise ValueError("at this threshold every item matches every leader")
    first = hashed(exact_hash_groups(items)).withColumnRenamed("first_ord", "n")
    lead = hashed(exact_hash_groups(leaders)).withColumnRenamed("first_ord", "n")
    near = _near(lead, first, _crowded(first, t), t, ordered=False)
    named = near.join(_merged(first.select(F.col("n").alias("hi"), "phash", "ahash")), "hi")
    return items.select("ord", "phash", "ahash").join(_merged(named), ["phash", "ahash"]).select("ord", F.col("lo").alias("leader_ord"))


def _slice_cost(part: DataFrame, crowded: DataFrame | None, t: int) -> tuple[int, int]:
    """Items in a slice, and comparisons needed inside it."""
    sizes = _keyed(part, crowded, t).groupBy("kind", "key", "a_kind", "a_key").agg(F.count("*").alias("c"))
    # each item has one key of the first kind of either hash
    rows, cost = sizes.agg(
        F.sum(F.expr("if(kind = 0 and a_kind <= 0, c, 0)")), F.sum(F.expr("cast(c as double) * (c - 1) / 2"))).first()
    return rows or 0, int(cost or 0)


def _settle(part: DataFrame, crowded: DataFrame | None, t: int) -> tuple[DataFrame, DataFrame]:
    """Leaders of a slice, and its members as ``(n, leader_n)``.

    Rounds: an item whose earlier neighbours are all gone leads; whatever is
    near it belongs to it and is gone.
    """
    pairs = materialise(_near(part, part, crowded, t, ordered=True), "near")
    left, members = pairs, []
    while not left.isEmpty():
        ends = left.select(F.expr("inline(array(struct(lo, false as later), struct(hi as lo, true as later)))"))
        heads = ends.groupBy("lo").agg(F.max("later").alias("later")).filter("not later").select("lo")
        gone = materialise(left.join(_merged(heads), "lo", "left_semi").select(F.col("hi").alias("n")).distinct(), "members")
        members.append(gone)
        # pairs of a member go; a leader keeps none, as all it touched are members
        left = materialise(
            left.join(_merged(gone.withColumnRenamed("n", "lo")), "lo", "left_anti")
            .join(_merged(gone.withColumnRenamed("n", "hi")), "hi", "left_anti"), "near")
    if not members:
        return part, part.select("n", F.col("n").alias("leader_n")).filter(F.lit(False))
    all_members = reduce(DataFrame.unionByName, members)
    leaders = part.join(_merged(all_members), "n", "left_anti")
    joined = (
        pairs.join(_merged(all_members.withColumnRenamed("n", "lo")), "lo", "left_anti")
        .groupBy(F.col("hi").alias("n")).agg(F.min("lo").alias("leader_n"))
    )
    return leaders, joined


def _hash_leaders(first: DataFrame, t: int, slice_size: int) -> DataFrame:
    """``(n, leader_n)`` for numbered distinct hashes ``first(n, p, a)``."""
    total = first.count()
    if not total:
        return first.select("n", F.col("n").alias("leader_n"))
    crowded = _crowded(first, t)
    undecided, settled = first, []
    done = 0
    while done < total:
        while True:
            part = undecided.filter(F.col("n").between(done + 1, done + slice_size))
            rows, cost = _slice_cost(part, crowded, t)
            if cost <= max(PAIR_BUDGET, PAIRS_PER_ITEM * rows) or slice_size <= SMALLEST_SLICE:
                break
            slice_size = max(slice_size // 4, SMALLEST_SLICE)
        done += slice_size
        slice_size *= GROWTH
        if not rows:
            continue
        leaders, members = _settle(part, crowded, t)
        leaders = materialise(leaders, "leaders")
        settled += [leaders.select("n", F.col("n").alias("leader_n")), members]
        if done < total:
            rest = undecided.filter(F.col("n") > done)
            covered = materialise(
                _near(leaders, rest, crowded, t, ordered=False).groupBy(F.col("hi").alias("n")).agg(F.min("lo").alias("leader_n")),
                "covered")
            settled.append(covered)
            undecided = materialise(rest.join(_merged(covered), "n", "left_anti"), "undecided")
    return reduce(DataFrame.unionByName, settled)


def leader_groups(items: DataFrame, t: int = fixed.SIMILARITY_THRESHOLD, slice_size: int = FIRST_SLICE) -> DataFrame:
    """``items(ord, phash, ahash, ...)`` plus ``leader_ord`` and ``group_no``.

    Groups are numbered from 1 in the order of their leaders' arrival.
    """
    if t < 0:
        raise ValueError("threshold must not be negative")
    if t >= NIBBLES:  # everything is near the first item
        lowest = items.agg(F.min("ord")).first()[0]
        return items.withColumn("leader_ord", F.lit(lowest).cast("long")).withColumn("group_no", F.lit(1).cast("long"))
    # Kept first: numbering reads its rows twice, and images are not to be hashed for each.
    distinct = materialise(hashed(exact_hash_groups(items).withColumnRenamed("first_ord", "leader_ord")), "distinct")
    first = with_row_number(distinct.select("phash", "ahash", "p", "a", "leader_ord"), [], ["leader_ord"], "n")
    first = materialise(first, "hashes")
    found = materialise(_hash_leaders(first.select("n", "p", "a"), t, slice_size), "assigned")
    numbered = group_number(first.join(_merged(found.filter("n = leader_n")), "n").select("leader_n", "leader_ord"))
    by_hash = (
        first.select("n", "phash", "ahash").join(_merged(found), "n").join(_merged(numbered), "leader_n")
        .select("phash", "ahash", "leader_ord", "group_no")
    )
    return items.join(_merged(by_hash), ["phash", "ahash"])


def group_number(leaders: DataFrame) -> DataFrame:
    """Number leaders from 1 in order of arrival (``leader_ord``)."""
    return with_row_number(leaders, [], ["leader_ord"], "group_no")


def best_per_group(groups: DataFrame, quality: str = "size_bytes") -> DataFrame:
    """``(group_no, best_ord)``: the item of highest ``quality``, the first one on ties."""
    return groups.groupBy("group_no").agg(
        F.max_by("ord", F.struct(F.col(quality), -F.col("ord"))).alias("best_ord"))


def with_action(groups: DataFrame, quality: str = "size_bytes") -> DataFrame:
    """Add ``action``: ``Retained`` for the best of each group, else ``Deleted``."""
    joined = groups.join(_merged(best_per_group(groups, quality)), "group_no")
    kept = F.col("ord") == F.col("best_ord")
    return joined.withColumn("action", F.when(kept, F.lit("Retained")).otherwise(F.lit("Deleted"))).drop("best_ord")


def rank_in_group(acted: DataFrame) -> DataFrame:
    """Add ``rank``: the kept item first, the others as they arrived."""
    return with_row_number(acted, ["group_no"], [F.col("action") != "Retained", F.col("ord")], "rank")


def dedup_summary(acted: DataFrame) -> DataFrame:
    """Per group: items, kept item, removed items, bytes kept and removed."""
    kept = F.col("action") == "Retained"
    return acted.groupBy("group_no").agg(
        F.count("*").alias("n_items"),
        F.max(F.when(kept, F.col("ord"))).alias("kept_ord"),
        F.count_if(~kept).alias("n_removed"),
        F.sum(F.when(kept, F.col("size_bytes")).otherwise(0)).alias("bytes_kept"),
        F.sum(F.when(kept, 0).otherwise(F.col("size_bytes"))).alias("bytes_removed"))


def dedup(items: DataFrame, t: int = fixed.SIMILARITY_THRESHOLD, quality: str = "size_bytes") -> DataFrame:
    """Group report ``(group_no, rank, ord, action, size_kb, dims, ...)``.

    Nothing is deleted: ``action`` splits the rows into keep and drop tables.
    """
    acted = with_action(materialise(leader_groups(items, t), "groups"), quality)
    return (
        rank_in_group(acted)
        .withColumn("size_kb", size_kb(F.col("size_bytes")))
        .withColumn("dims", dims_label(F.col("width"), F.col("height")))
    )
