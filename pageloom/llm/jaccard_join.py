"""N-gram Jaccard join: MinHash LSH forest with exact verification.

A text is the set of its five-word shingles (fewer words: the whole sequence is
one shingle; no words: no shingle, and such a document is linked to nothing).
A null text equals an empty one.  Two different texts are linked when the Jaccard
similarity of their sets is at least ``threshold``, read to six decimals; a class
is a connected component of links, with equal texts in one class.  ``n_links`` is
the number of different texts of its class that a text is linked to, every one
of them counted.

**Forest.**  A signature of ``TREES * DEPTH`` minima gives each tree a label of
``DEPTH`` minima; a trie node is a prefix of a label.  Prefixes start at full
depth and are shortened by ``STEP`` until a pair at the threshold shares some
node with at least ``RECALL``: 1 - (1 - t ** p) ** TREES.

**Search.**  Equal texts collapse first.  Each node, of every prefix length, tests
its items against its most central item, the pivot; verified links join
components.  At the shortest prefix the items left outside the pivot's component get a pivot of
their own, and what is still apart is settled exactly.  A family, all items tested
against one pivot, has a reference set R: the pivot and the shingles that more
than half of the family hold beyond it.  An item lacks some of R (``missing``)
and has extra shingles, of which ``some`` occur in another item.  Two items have
at most ``|R| - max(missing)`` shingles of R in common and, if they share extra
shingles at all, ``min(some)`` others, which with both sizes bounds their
similarity.  So items of different components are compared when they share an
extra shingle or not, each under its bound; all others cannot be linked.  No
pair within a node is left out and no node emits all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageloom.llm import words as W
from pageloom.llm.components import components, merged
from pageloom.sources import scratch

TREES, DEPTH, STEP = 20, 6, 2
THRESHOLD, RECALL = 0.8, 0.9999

# A threshold is a number of millionths, so that slacks are whole numbers.
_UNIT = 1_000_000
# A component is dealt over this many parts, each with its own copy of the reference.
PARTS = 1024
# Holders of one shingle that a task takes at a time.
HOLDERS = 512
# Differences up to this long travel with their shingles; longer ones are joined later.
SHORT = 256
# Bits of the filter before the texts' join: 4 MB for any input.
SPOTS = 1 << 25

_FACTORS = np.random.default_rng(4).integers(1, 2**63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = np.random.default_rng(44).integers(1, 2**63, DEPTH, dtype=np.uint64) | np.uint64(1)
_TREE_SEEDS = np.random.default_rng(444).integers(1, 2**63, TREES, dtype=np.uint64)


def recall(depth: int, threshold: float) -> float:
    """Chance that a pair at the threshold shares a node of this depth."""
    return 1 - (1 - threshold**depth) ** TREES


def depths(threshold: float = THRESHOLD, target: float = RECALL) -> list[int]:
    """Prefix lengths from the full label down to the first that meets the target."""
    out = [DEPTH]
    while recall(out[-1], threshold) < target and out[-1] > 1:
        out.append(max(1, out[-1] - STEP))
    return out


def _nodes(shingles: np.ndarray, first: np.ndarray, lengths: list[int]) -> list[np.ndarray]:
    """For each prefix length the node of every (text, tree)."""
    n = len(first) - 1
    minima = np.empty((TREES * DEPTH, n), np.uint64)
    values = np.empty_like(shingles)
    for j, factor in enumerate(_FACTORS):
        minima[j] = W.per_text(np.minimum, np.multiply(shingles, factor, out=values), first, 0)
    minima = minima.reshape(TREES, DEPTH, n)
    out = []
    for length in lengths:
        total = _TREE_SEEDS[:, None] + (minima[:, :length] * _PLACES[:length, None]).sum(1, dtype=np.uint64)
        out.append(W.mix(total + np.uint64(length)).T.copy())
    return out


def _lists(values: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(values).view(np.int64).ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]), flat)


def sign(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """``(doc_id, key, n, nodes_0, nodes_1, ...)``: the number of shingles and the nodes of each prefix length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch):
                shingles, first = W.Words(part.column("text")).shingles()
                nodes = [_lists(x) for x in _nodes(shingles, first, lengths)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("key"), pa.array(np.diff(first)), *nodes],
                    ["doc_id", "key", "n", *[f"nodes_{k}" for k in range(len(nodes))]],
                )

    schema = "doc_id long, key string, n long" + "".join(f", nodes_{k} array<long>" for k in range(len(lengths)))
    return _keyed(docs).mapInArrow(run, schema)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(text).alias("key"), text.alias("text"))


def _sets(keyed: DataFrame) -> DataFrame:
    """``(id, shingles)`` of ``(id, text)``; distinct shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch):
                shingles, first = W.Words(part.column("text")).shingles()
                sets = [np.unique(shingles[a:b]).view(np.int64) for a, b in zip(first[:-1], first[1:], strict=True)]
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets)))], ["id", "shingles"])

    return keyed.select("id", "text").mapInArrow(run, "id long, shingles array<long>")


def _likely(keyed: DataFrame, want: DataFrame) -> DataFrame:
    """Rows of ``keyed`` that can be in ``want (key, first_id)``, by a bitmap of fixed size.

    No wanted row goes; of the others a share of at most ``rows of want / SPOTS``
    stays, which the exact join drops.  So texts that share no node are not moved.
    """
    def spot(*names: str):
        return F.pmod(F.xxhash64(*names), F.lit(SPOTS)).alias("spot")

    marks = want.select(spot("key", "first_id")).groupBy(F.expr("bitmap_bucket_number(spot)").alias("bucket"))
    marks = marks.agg(F.expr("bitmap_construct_agg(bitmap_bit_position(spot))").alias("bits"))
    rows = keyed.select("*", spot("key", "doc_id")).withColumn("bucket", F.expr("bitmap_bucket_number(spot)"))
    rows = rows.join(F.broadcast(marks), "bucket").withColumn("place", F.expr("bitmap_bit_position(spot)"))
    byte = "cast(conv(hex(substring(bits, cast(place div 8 as int) + 1, 1)), 16, 10) as int)"
    return rows.filter(F.expr(f"shiftright({byte}, cast(place % 8 as int)) % 2 = 1")).select(*keyed.columns)


def _salted(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs (a, b)`` with the sets of b, where one b may be in a third of all pairs."""
    part = F.pmod(F.xxhash64("a"), F.lit(PARTS))
    pairs = pairs.withColumn("part", part)
    copies = pairs.select("b", "part").distinct().join(merged(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))), "b")
    return pairs.join(merged(copies), ["b", "part"]).drop("part")


def _verify(pairs: DataFrame, sets: DataFrame, threshold: float, label: str, extras: bool = False) -> DataFrame:
    """Sizes, overlap and link of the pairs ``(a, b)``; with ``extras``, what a holds beyond b."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    out = _salted(pairs, sets).join(merged(left), "a").select(
        "a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), F.size(F.array_intersect("sa", "sb")).alias("shared"),
        *([F.array_except("sa", "sb").alias("extra")] if extras else []),
    )
    return scratch.materialise(out.withColumn("linked", F.expr(f"shared * {_UNIT}L >= {round(threshold * _UNIT)}L * (na + nb - shared)")), label)


def _pivots(items: DataFrame, node: str) -> DataFrame:
    return items.groupBy(node).agg(F.max(F.struct("central", "id")).getField("id").alias("pivot"))


def _apart(x: str, y: str):
    """What one set holds and the other does not."""
    return F.concat(F.array_except(x, y), F.array_except(y, x))


def _slacks(labels: DataFrame, wanted: DataFrame, sets: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """``(comp, id, slack)`` of the texts of components of two or more, and ``(comp, id, slack, d)`` of those whose
    difference has shingles ``(f, e)`` that f >= 2 differences hold, rarest first."""
    member = labels.join(merged(wanted), "id").withColumn("part", F.pmod(F.xxhash64("id"), F.lit(PARTS)))
    # Parts come first: a component that holds a third of all texts is never one group of rows.
    part = scratch.materialise(member.groupBy("comp", "part").agg(F.count("*").alias("size"), F.max(F.struct("central", "id")).alias("best")), "parts")
    comp = part.groupBy("comp").agg(F.sum("size").alias("size"), F.max("best").getField("id").alias("pivot")).filter("size > 1")
    pivot = comp.join(merged(sets.select(F.col("id").alias("pivot"), F.col("shingles").alias("ref"))), "pivot")
    ref = part.select("comp", "part").join(merged(pivot), "comp")
    item = member.join(merged(ref), ["comp", "part"]).join(merged(sets), "id").select("comp", "part", "id", F.col("size").alias("of"), F.size("shingles").alias("n"), _apart("shingles", "ref").alias("d"))
    item = scratch.materialise(item, "differences")
    # From the pivot to the majority: shingles in which most differ from the pivot change sides.
    held = item.select("comp", "of", F.explode("d").alias("e")).groupBy("comp", "of", "e").agg(F.count("*").alias("k"))
    held = scratch.materialise(held.filter("k > 1"), "holders")
    turned = held.filter("2 * k > of").groupBy("comp").agg(F.collect_list("e").alias("turned"))
    turned = part.select("comp", "part").join(merged(turned), "comp")
    item = item.join(merged(turned), ["comp", "part"], "left").withColumn("d", F.when(F.col("turned").isNull(), F.col("d")).otherwise(_apart("d", "turned")))
    t = round(threshold * _UNIT)
    item = item.select("comp", "id", F.expr(f"{_UNIT - t}L * n - {_UNIT + t}L * size(d)").alias("slack"), "d")
    item = scratch.materialise(item, "slacks")
    often = held.select("comp", "e", F.expr("if(2 * k > of, of - k, k)").alias("f")).filter("f > 1")
    d = item.select("comp", "id", "slack", F.explode("d").alias("e")).join(merged(often), ["comp", "e"])
    d = d.groupBy("comp", "id", "slack").agg(F.array_sort(F.collect_list(F.struct("f", "e"))).alias("d"))
    return item.drop("d"), scratch.materialise(d, "shared-differences")


def count_links(labels: DataFrame, wanted: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """``(id, n_links)``: the linked texts of every text that has one in its component."""
    item, d = _slacks(labels, wanted, sets, threshold)
    # By rank: of a component's slacks, how many reach what a slack lacks.
    counts = item.groupBy("comp", "slack").agg(F.count("*").alias("k"))
    marks = counts.select("comp", F.col("slack").alias("v"), "k", F.lit(None).cast("long").alias("slack"))
    marks = marks.unionAll(counts.select("comp", -F.col("slack"), F.lit(0).cast("long"), "slack"))
    ranked = marks.withColumn("reach", F.sum("k").over(Window.partitionBy("comp").orderBy(F.desc("v")))).filter("slack is not null")
    plain = item.join(merged(ranked.select("comp", "slack", "reach")), ["comp", "slack"]).select("id", F.expr("reach - if(slack >= 0, 1, 0)").alias("n"))

    # By shared differences: only pairs whose slacks do not suffice, and only where enough shingles are left.
    unit = 2 * (_UNIT + round(threshold * _UNIT))
    short = F.when(F.size("d") <= SHORT, F.col("d.e"))
    end = d.select("comp", "id", "slack", F.size("d").alias("long"), short.alias("d"), F.posexplode("d").alias("pos", "s"))
    end = end.select("comp", "id", "slack", (F.col("long") - F.col("pos")).alias("left"), "d", F.col("s.e").alias("e"), F.ceil(F.col("s.f") / HOLDERS).alias("salts"))
    names = ("id", "slack", "left", "d")
    x = end.select("comp", "e", F.expr("pmod(id, salts)").alias("salt"), *[F.col(c).alias(f"{c}_x") for c in names])
    y = end.select("comp", "e", F.explode(F.expr("sequence(0L, salts - 1)")).alias("salt"), *[F.col(c).alias(f"{c}_y") for c in names])

    def meet(x: DataFrame, y: DataFrame) -> DataFrame:
        lack = "-(slack_x + slack_y)"
        return x.join(merged(y), ["comp", "e", "salt"]).filter(f"id_x < id_y and {lack} > 0 and left_x * {unit}L >= {lack} and left_y * {unit}L >= {lack}")

    both = F.array_intersect("d_x", "d_y")
    # A pair meets on several shingles; it counts on the first.
    near = meet(x.filter("d_x is not null"), y.filter("d_y is not null")).filter(
        (both[0] == F.col("e")) & (F.size(both) * F.lit(unit) + F.col("slack_x") + F.col("slack_y") >= 0)).select("id_x", "id_y")
    far = meet(x.filter("d_x is null"), y).unionAll(meet(x.filter("d_x is not null"), y.filter("d_y is null")))
    far = far.select("id_x", "id_y", "slack_x", "slack_y").distinct()
    for c in "xy":
        far = far.join(merged(d.select(F.col("id").alias(f"id_{c}"), F.col("d.e").alias(f"all_{c}"))), f"id_{c}")
    far = far.filter(F.size(F.array_intersect("all_x", "all_y")) * F.lit(unit) + F.col("slack_x") + F.col("slack_y") >= 0).select("id_x", "id_y")
    more = near.unionAll(far).select(F.explode(F.array("id_x", "id_y")).alias("id")).groupBy("id").agg(F.count("*").alias("n"))
    return plain.unionAll(more).groupBy("id").agg(F.sum("n").alias("n_links")).filter("n_links > 0")


def search(texts: DataFrame, keyed: DataFrame, lengths: list[int], threshold: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(id, comp)`` of the texts that share a node, how ``central`` each is, and their sets."""
    last = f"node_{len(lengths) - 1}"
    names = [f"nodes_{k}" for k in range(len(lengths))]
    node = texts.select("id", F.explode(F.arrays_zip(*names)).alias("n")).select("id", *[F.col(f"n.nodes_{k}").alias(f"node_{k}") for k in range(len(lengths))])
    sizes = node.groupBy(last).count().filter("count > 1")
    held = scratch.materialise(node.join(merged(sizes), last), "held")
    # Tables that several joins read are written, so that each plan holds few of them: a plan is
    # gone over in the driver again after each of its shuffles, at a cost of the square of its length.
    wanted = scratch.materialise(held.groupBy("id").agg(F.sum("count").alias("central")), "wanted")
    held = scratch.materialise(held.drop("count").join(merged(wanted), "id"), "central")
    want = texts.join(merged(wanted), "id", "left_semi").select("id", "key", F.col("doc_id").alias("first_id"))
    want = scratch.materialise(want, "want")
    keyed = _likely(keyed, want)
    chosen = keyed.join(merged(want), (keyed.key == want.key) & keyed.doc_id.eqNullSafe(want.first_id)).select("id", "text")
    # Kept by id, so that no join with them moves them again.
    sets = scratch.materialise_bucketed(_sets(chosen).dropDuplicates(["id"]), ["id"], "sets")

    tested, labels = None, wanted.select("id", F.col("id").alias("comp"))

    def test(pairs: DataFrame, label: str, extras: bool = False) -> DataFrame:
        nonlocal tested, labels
        pairs = pairs.filter("a <> b").distinct()
        if tested is not None:
            done = tested.unionAll(tested.select(F.col("b").alias("a"), F.col("a").alias("b")))
            pairs = pairs.join(merged(done), ["a", "b"], "left_anti")
        found = _verify(scratch.materialise(pairs, f"{label}-pairs"), sets, threshold, label, extras)
        tested = found.select("a", "b") if tested is None else tested.unionAll(found.select("a", "b"))
        linked = found.filter("linked").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        if linked.isEmpty():
            return found
        # Only components that new links join are relabelled.
        of = lambda end: labels.select(F.col("id").alias(end), F.col("comp").alias(f"of_{end}"))
        between = linked.join(merged(of("a")), "a").join(merged(of("b")), "b").filter("of_a <> of_b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
        moved = components(between).select(F.col("id").alias("comp"), F.col("comp").alias("to"))
        labels = scratch.materialise(labels.join(merged(moved), "comp", "left").select("id", F.coalesce("to", "comp").alias("comp")), "comps")
        return found

    # Pivots of all prefix lengths are tested in one go; those of the last give the families.
    at = scratch.materialise(held.join(merged(_pivots(held, last)), last).select("id", last, "central", "pivot"), "pivots")
    first = at.select(F.col("id").alias("a"), F.col("pivot").alias("b"))
    for k in range(len(lengths) - 1):
        first = first.unionAll(held.join(merged(_pivots(held, f"node_{k}")), f"node_{k}").select(F.col("id").alias("a"), F.col("pivot").alias("b")))
    star = test(first, "star", extras=True)

    def apart() -> DataFrame:
        comp = labels.select(F.col("id").alias("pivot"), F.col("comp").alias("of"))
        return at.join(merged(labels), "id").join(merged(comp), "pivot").filter("comp <> of")

    stray = scratch.materialise(apart().select("id", last, "central"), "stray")
    own = _pivots(stray, last).withColumnRenamed("pivot", "second")
    test(stray.join(merged(own), last).select(F.col("id").alias("a"), F.col("second").alias("b")), "second")

    # What is still apart from its pivot, exactly.  A family's reference set is its
    # pivot and the shingles that more than half of its items hold beyond it.
    open_ = apart().select(F.col("pivot").alias("p")).distinct()
    rel = star.join(merged(open_), star.b == F.col("p"), "left_semi").join(merged(labels), star.a == labels.id)
    rel = scratch.materialise(rel.select(F.col("b").alias("p"), F.col("a").alias("x"), "comp", F.col("na").alias("n"), "nb", "shared", "linked", "extra"), "rel")
    family = rel.groupBy("p").agg(F.count("*").alias("size"))
    beyond = rel.select("p", "x", "comp", F.explode("extra").alias("e"))
    held_by = beyond.groupBy("p", "e").agg(F.count("*").alias("k"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("k > 1").join(merged(family), "p")
    held_by = scratch.materialise(held_by.select("p", "e", (F.col("lo") < F.col("hi")).alias("mixed"), (2 * F.col("k") > F.col("size")).alias("common")), "held-by")
    grown = held_by.filter("common").groupBy("p").agg(F.count("*").alias("grown"))
    # Written once: counts and candidates come from the shared shingles alone.
    shared = scratch.materialise(beyond.select("p", "x", "e").join(merged(held_by), ["p", "e"]), "shared")
    own = shared.groupBy("p", "x").agg(F.count_if("common").alias("has"), F.count_if(~F.col("common")).alias("some"))
    zero = F.lit(0)
    rel = rel.join(merged(grown), "p", "left").join(merged(own), ["p", "x"], "left").select(
        "p", "x", "comp", "n", "linked", (F.col("nb") + F.coalesce("grown", zero)).alias("ref"),
        (F.col("nb") + F.coalesce("grown", zero) - F.col("shared") - F.coalesce("has", zero)).alias("missing"), F.coalesce("some", zero).alias("some"),
    )
    rel = scratch.materialise(rel, "family")
    rel_y = rel.select("p", F.col("x").alias("y"), F.col("comp").alias("comp_y"), F.col("n").alias("ny"), F.col("linked").alias("linked_y"), F.col("missing").alias("missing_y"), F.col("some").alias("some_y"))

    def within(most: str) -> str:
        return f"not (linked and linked_y) and ({most}) >= {threshold}D * (n + ny - ({most}))"

    # With a shared extra shingle: only those that another item holds can be common.
    mixed = shared.filter("mixed and not common").select("p", "x", "e")
    of_x, of_y = mixed.join(merged(rel), ["p", "x"]), mixed.withColumnRenamed("x", "y").join(merged(rel_y), ["p", "y"])
    share = of_x.join(merged(of_y), ["p", "e"]).filter(f"comp < comp_y and {within('ref - greatest(missing, missing_y) + least(some, some_y)')}")
    share = share.select(F.col("x").alias("a"), F.col("y").alias("b"))
    # Without one: families are compared by their distinct (size, missing) values.
    kinds = rel.groupBy("p", "n", "missing").agg(F.first("ref").alias("ref"), F.min("linked").alias("linked"))
    kinds_y = kinds.select("p", F.col("n").alias("ny"), F.col("missing").alias("missing_y"), F.col("linked").alias("linked_y"))
    reach = kinds.join(merged(kinds_y), "p").filter(within("ref - greatest(missing, missing_y)")).select("p", "n", "missing", "ny", "missing_y")
    near = reach.join(merged(rel.select("p", "x", "comp", "n", "missing")), ["p", "n", "missing"]).join(merged(rel_y.select("p", "y", "comp_y", "ny", "missing_y")), ["p", "ny", "missing_y"])
    near = near.filter("comp < comp_y").select(F.col("x").alias("a"), F.col("y").alias("b"))
    test(share.unionAll(near), "rest")
    return labels, wanted, sets


def _known(docs: DataFrame, threshold: float, target: float) -> tuple[DataFrame, DataFrame, tuple]:
    """Signed documents, ``(id, key, comp, class_id, n_copies)`` of the different texts with words, and what counting links needs."""
    lengths = depths(threshold, target)
    signed = scratch.materialise(sign(docs, lengths), "signed")
    names = [f"nodes_{k}" for k in range(len(lengths))]
    texts = signed.filter("n > 0").groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n_copies"), *[F.first(c).alias(c) for c in names])
    texts = scratch.materialise(texts.select(F.monotonically_increasing_id().alias("id"), "*"), "texts")
    labels, wanted, sets = search(texts, _keyed(docs), lengths, threshold)
    known = texts.select("id", "key", "doc_id", "n_copies").join(merged(labels), "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    least = known.groupBy("comp").agg(F.min("doc_id").alias("class_id"))
    known = scratch.materialise(known.join(merged(least), "comp").select("id", "key", F.coalesce("class_id", "doc_id").alias("class_id"), "n_copies"), "known")
    return signed, known, (labels, wanted, sets, threshold)


def _rows(signed: DataFrame, known: DataFrame) -> DataFrame:
    """Every document with what is known of its text; one without words is its own class."""
    return signed.select("doc_id", "key").join(merged(known), "key", "left").select(
        "doc_id", "key", F.when(F.col("n_copies").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        *[F.coalesce(c, F.lit(n).cast("long")).alias(c) for c, n in (("n_copies", 1), ("n_links", 0)) if c in known.columns],
    )


def join(docs: DataFrame, threshold: float = THRESHOLD, target: float = RECALL) -> DataFrame:
    """``(doc_id, key, class_id, n_copies, n_links)``, one row for each row of ``docs``.

    ``key`` is the MD5 of the text, ``class_id`` the least ``doc_id`` of the class
    (null ids aside), ``n_copies`` the rows with an equal text.  A document
    without words is its own class.  No rows give none; other columns are not read.
    """
    signed, known, found = _known(docs, threshold, target)
    known = known.join(merged(count_links(*found)), "id", "left").drop("id")
    return _rows(signed, scratch.materialise(known, "linked"))


def keep_first(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class: that with the least id; documents without words all stay."""
    signed, known, _ = _known(docs, threshold, RECALL)
    classes = _rows(signed, known.drop("id"))
    keep = classes.filter("doc_id <=> class_id").groupBy("doc_id", "key").agg(F.max("n_copies").alias("n_copies"), F.count("*").alias("n"))
    columns = docs.columns
    row = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("i"), F.md5(F.coalesce("text", F.lit(""))).alias("k"), F.length(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", "")).alias("c"))
    kept = row.join(merged(keep), F.col("i").eqNullSafe(keep.doc_id) & (F.col("k") == keep.key))
    once = kept.filter("n = 1 or c = 0").select("row.*")
    again = kept.filter("n > 1 and c > 0").select("i", "k", "row").dropDuplicates(["i", "k"]).select("row.*")
    return once.unionAll(again).select(*[f"`{c}`" for c in columns])
