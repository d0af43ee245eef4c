"""Personal data: patterns, and terms that give protected values away.

**Patterns.**  Email, ip, card and phone are found leftmost and without overlap
per kind; matches that fail their check (parts over 255, digits, Luhn) are
dropped and not retried.  Spans count code points, end exclusive.

**Disclosure.**  A found value is a protected entity.  Masking it is not enough
where a word nearby tells which value was there.  How much a term tells of an
entity is measured on the corpus: with n(c) contexts of the entity, n(t)
occurrences of the term and n(c, t) of both within ``WINDOW`` words, the
pointwise mutual information log2(n(c, t) * N / (n(c) * n(t))) is set against the
entity's own information log2(N / n(c)).  Their ratio is 1 when the term occurs
with that entity alone.  A term whose ratio reaches ``GENERALISE`` is replaced
by its shape wherever it stands in a document holding the entity; from
``REMOVE`` on it is taken out.  A pair needs ``SUPPORT`` different contexts (the
words around a value, so copies of one passage count once): without it a
ratio says nothing.  Terms are runs of ``TERM`` or more letters, in lower case.

The terms beside a span are taken by place from all terms of its text, whatever
lies between, found by binary search; only words near spans are paired, so pairs
grow with the spans.  Terms of the whole corpus are counted
with map-side combine.  Everything is joined on hashed keys, with no group held
whole.

Null and empty texts have no spans.  Repeated rows each get the same spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.sources import scratch

KINDS = ("email", "ip", "card", "phone")
DISCLOSING = "term"
WINDOW, TERM, SUPPORT = 6, 4, 3
GENERALISE, REMOVE = 0.9, 0.97

#: The stated patterns, possessive where that cannot change a match, so that long runs cost linear time and no stack.
#: A match of email or ip begins where a run of its characters or the search begins: any later start in the run would match only if that one did.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without a match of this has no match of the kind.
MAY_HAVE = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": "+"}
_PART = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]+", "")


def _luhn(digits: Column) -> Column:
    """Luhn sum, every second digit from the right doubled."""
    places = F.split(F.reverse(digits), "")
    doubled = F.transform(places, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(F.when(d.cast("int") > 4, 2 * d.cast("int") - 9).otherwise(2 * d.cast("int"))))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def holds(kind: str, match: Column) -> Column:
    """Whether a match passes the check of its kind."""
    if kind == "ip":
        return match.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        n = F.length(_digits(match))
        return F.when(n.between(13, 19), _luhn(_digits(match))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


BLOCK, TERM_BLOCK = 256, 32
_TERMS = rf"\p{{L}}{{{TERM},}}"


def _with_ends(rows: DataFrame, names: list[str], size: int = BLOCK) -> DataFrame:
    """Adds ``e_x`` to arrays ``m_x`` of matches and ``p_x`` of pieces: where each match ends.

    Running lengths are taken within blocks and over blocks, so a text with very
    many matches does not cost their square.
    """
    def total(array: Column) -> Column:
        return F.aggregate(array, F.lit(0), lambda a, x: a + x)

    def lengths(name: str) -> Column:
        return F.transform(f"m_{name}", lambda m, i: F.length(F.get(f"p_{name}", i)) + F.length(m))

    def before(name: str) -> Column:
        start = F.expr("named_struct('at', 0, 'out', cast(array() as array<int>))")
        blocks = F.sequence(F.lit(0), F.floor((F.size(f"l_{name}") - 1) / size).cast("int"))
        add = lambda a, b: F.struct((a["at"] + total(F.slice(f"l_{name}", b * size + 1, F.lit(size)))).alias("at"), F.array_append(a["out"], a["at"]).alias("out"))
        return F.aggregate(blocks, start, add, lambda a: a["out"])

    def ends(name: str) -> Column:
        block = lambda i: F.floor(i / size).cast("int")
        return F.transform(f"l_{name}", lambda x, i: F.get(f"b_{name}", block(i)) + total(F.slice(f"l_{name}", block(i) * size + 1, i % size + 1)))

    for prefix, of in (("l", lengths), ("b", before), ("e", ends)):
        rows = rows.select("*", *[F.when(F.size(f"m_{n}") > 0, of(n)).alias(f"{prefix}_{n}") for n in names])
    return rows


def base_spans(rows: DataFrame) -> DataFrame:
    """Adds ``spans`` to rows with ``text``: kind, s, e, value, nearby terms and their context, by kind and start.

    A kind's matches alternate with the pieces between them, so the running
    lengths of both give the places; so do the text's terms.
    """
    kept = [F.col(f"`{c}`") for c in rows.columns]
    none = F.array().cast("array<string>")

    def matches(kind: str) -> Column:
        may = F.col("text").contains(MAY_HAVE[kind]) if len(MAY_HAVE[kind]) == 1 else F.col("text").rlike(MAY_HAVE[kind])
        return F.when(may, F.regexp_extract_all("text", F.lit(PATTERNS[kind]), F.lit(0))).otherwise(none).alias(f"m_{kind}")

    found = rows.select(*kept, *[matches(k) for k in KINDS])
    pieces = found.select("*", *[F.when(F.size(f"m_{k}") > 0, F.split("text", PATTERNS[k], -1)).otherwise(none).alias(f"p_{k}") for k in KINDS])
    placed = _with_ends(pieces, list(KINDS))

    def spans(kind: str) -> Column:
        def span(m: Column, i: Column) -> Column:
            end = F.get(f"e_{kind}", i)
            return F.struct(F.lit(kind).alias("kind"), (end - F.length(m)).alias("s"), end.alias("e"), m.alias("value"))

        return F.filter(F.transform(f"m_{kind}", span), lambda x: holds(kind, x["value"]))

    valid = placed.select(*kept, F.concat(*[spans(k) for k in KINDS]).alias("__spans"))
    some = F.size("__spans") > 0
    worded = valid.select(
        "*", F.when(some, F.regexp_extract_all("text", F.lit(_TERMS), F.lit(0))).otherwise(none).alias("m___w"),
        F.when(some, F.split("text", _TERMS, -1)).otherwise(none).alias("p___w"))
    worded = _with_ends(worded, ["__w"], TERM_BLOCK)

    def ended(place: Column) -> Column:
        """How many terms end at the place or before."""
        def halve(a: Column, _: Column) -> Column:
            mid = F.floor((a["lo"] + a["hi"]) / 2).cast("int")
            before = F.get("e___w", mid) <= place
            halved = F.struct(F.when(before, mid + 1).otherwise(a["lo"]).alias("lo"), F.when(before, a["hi"]).otherwise(mid).alias("hi"))
            return F.when(a["lo"] < a["hi"], halved).otherwise(a)

        steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size("m___w") + 1)).cast("int"))
        return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size("m___w").alias("hi")), halve, lambda a: a["lo"])

    def counted(x: Column) -> Column:
        return F.struct(*[x[c].alias(c) for c in ("kind", "s", "e", "value")], ended(x["s"]).alias("before"), ended(x["e"]).alias("upto"))

    def with_terms(x: Column) -> Column:
        # A term that begins in the value and goes on beyond it is on neither side.
        across = F.coalesce(F.get("e___w", x["upto"]) - F.length(F.get("m___w", x["upto"])) < x["e"], F.lit(False)).cast("int")
        sides = {"left": (F.greatest(x["before"] - WINDOW, F.lit(0)), F.least(x["before"], F.lit(WINDOW))), "right": (x["upto"] + across, F.lit(WINDOW))}
        return F.struct(
            *[x[c].alias(c) for c in ("kind", "s", "e", "value")],
            *[F.transform(F.slice("m___w", at + 1, n), F.lower).alias(side) for side, (at, n) in sides.items()])

    placed = worded.select("*", F.transform("__spans", counted).alias("__counted"))
    return placed.select(*kept, F.transform("__counted", with_terms).alias("spans"))


def disclosing(spans: DataFrame, corpus: DataFrame) -> DataFrame:
    """``(entity, term, ratio)`` of the terms that tell enough of an entity.

    ``spans`` has ``entity``, ``left`` and ``right``; ``corpus`` has ``text``.
    """
    near = spans.select("entity", F.xxhash64("left", "right").alias("context"), F.explode(F.array_distinct(F.concat("left", "right"))).alias("term"))
    seen = near.groupBy("entity", "term", "context").agg(F.count("*").alias("n"))
    seen = seen.groupBy("entity", "term").agg(F.sum("n").alias("n_both"), F.count("*").alias("contexts")).filter(F.col("contexts") >= SUPPORT)
    seen = scratch.materialise(seen, "pairs")
    words = corpus.select(F.explode(F.regexp_extract_all("text", F.lit(_TERMS), F.lit(0))).alias("term")).select(F.lower("term").alias("term"))
    counted = scratch.materialise(words.groupBy("term").agg(F.count("*").alias("n_term")), "terms")
    total = counted.agg(F.coalesce(F.sum("n_term"), F.lit(0))).first()[0]
    entities = spans.groupBy("entity").agg(F.count("*").alias("n_entity"))
    joined = seen.join(counted, "term").join(entities, "entity")
    both = F.least("n_both", "n_term")
    own = F.log2(F.lit(float(max(total, 1))) / F.col("n_entity"))
    mutual = F.log2(both * F.lit(float(max(total, 1))) / (F.col("n_entity") * F.col("n_term")))
    return joined.select("entity", "term", F.when(own > 0, F.least(F.lit(1.0), mutual / own)).otherwise(0.0).alias("ratio")).filter(F.col("ratio") >= GENERALISE)


def find(docs: DataFrame, carry_text: bool = False) -> DataFrame:
    """``(doc_id, spans, terms)`` of every row: base spans, and spans of disclosing terms with their ratio.

    With ``carry_text`` the text stays beside them.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = base_spans(rows).select("doc_id", F.md5("text").alias("key"), "spans", *([F.col("text")] if carry_text else [F.when(F.size("spans") > 0, F.col("text")).alias("text")]))
    found = scratch.materialise(found, "spans")
    entity = F.concat_ws(":", "x.kind", "x.value").alias("entity")
    some = found.filter(F.size("spans") > 0)
    spans = some.select(F.explode("spans").alias("x")).select(entity, "x.left", "x.right")
    flagged = scratch.materialise(disclosing(spans, rows), "disclosing")
    held = some.select("key", F.explode("spans").alias("x")).select("key", entity).distinct()
    by_text = held.join(flagged, "entity").groupBy("key", "term").agg(F.max("ratio").alias("ratio"))
    by_text = by_text.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("term", "ratio"))).alias("flagged"))
    by_text = scratch.materialise(by_text, "flagged")
    out = found.join(by_text, "key", "left")
    pattern = F.when(F.col("flagged").isNotNull(), F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join(F.transform("flagged", lambda x: x["term"]), "|"), F.lit(r")(?!\p{L})")))
    out = out.select("*", pattern.alias("pattern"))
    out = out.select("*", F.when(F.col("pattern").isNotNull(), F.regexp_extract_all("text", F.col("pattern"), F.lit(0))).alias("m_t"), F.when(F.col("pattern").isNotNull(), F.split("text", F.col("pattern"), -1)).alias("p_t"))
    out = _with_ends(out, ["t"])

    def term(m: Column, i: Column) -> Column:
        end = F.get("e_t", i)
        of = F.filter("flagged", lambda x: x["term"] == F.lower(m))
        return F.struct(F.lit(DISCLOSING).alias("kind"), (end - F.length(m)).alias("s"), end.alias("e"), m.alias("value"), F.coalesce(F.get(of, F.lit(0))["ratio"], F.lit(GENERALISE)).alias("ratio"))

    inside = lambda x: F.exists("spans", lambda b: (b["s"] <= x["s"]) & (x["e"] <= b["e"]))
    terms = F.coalesce(F.filter(F.transform("m_t", term), lambda x: ~inside(x)), F.expr("cast(array() as array<struct<kind:string,s:int,e:int,value:string,ratio:double>>)"))
    return out.select("doc_id", "spans", terms.alias("terms"), *(["text"] if carry_text else []))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts per kind, the hash of the base spans and all spans as text."""
    kinds = F.transform("spans", lambda x: x["kind"])
    counts = [F.size(F.array_remove(kinds, k)).cast("long") for k in KINDS]
    counts = [(F.size("spans") - n).cast("long").alias(f"n_{k}") for k, n in zip(KINDS, counts, strict=True)]
    base, added = _listed(F.col("spans")), _listed(F.col("terms"))
    every = F.concat_ws(",", F.when(base != "", base), F.when(added != "", added))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), every.alias("spans"), F.size("terms").cast("long").alias("n_terms"))


def sanitise(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` with values replaced by their kind, disclosing terms by their shape or by nothing.

    Where spans overlap, the one that begins first stands, the longer of two that begin together.
    """
    found = find(docs, carry_text=True)
    label = lambda x: F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]"))
    base = F.transform("spans", lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("e"), label(x).alias("by")))
    shape = lambda x: F.when(x["ratio"] >= REMOVE, "").otherwise(F.regexp_replace(x["value"], r"\p{L}+", "[WORD]"))
    added = F.transform("terms", lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("e"), shape(x).alias("by")))
    start = F.expr("named_struct('at', 0, 'out', cast(array() as array<string>))")

    def step(a: Column, x: Column) -> Column:
        piece = F.concat(F.substring(F.col("text"), a["at"] + 1, x["s"] - a["at"]), x["by"])
        done = F.struct((-x["e"]).alias("at"), F.array_append(a["out"], piece).alias("out"))
        return F.when(x["s"] >= a["at"], done).otherwise(a)

    joined = F.aggregate("all", start, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substring(F.col("text"), a["at"] + 1, F.length("text"))))
    return found.select("doc_id", "text", F.sort_array(F.concat(base, added)).alias("all")).select("doc_id", joined.alias("text"))
