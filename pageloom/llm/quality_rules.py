"""Quality rules under weak supervision.

Rules over counted properties of a text vote good, bad or abstain.  How far
each vote can be trusted is not set by hand: expectation-maximisation over all
documents estimates, for good and for bad documents, how often each rule votes
each way.  A document's posterior probability of being good weighs its votes by
those estimates, so one weak rule no longer rejects a document that the others
support.  A prior worth ``PRIOR_SHARE`` of the documents holds the classes to
their meaning, and a vote never counts against its own direction.

The votes of all documents are summed to counts per pattern of votes (at most
three to the number of rules, whatever the data), and the iterations are small
aggregations of that table.

A null text is empty: no words, so the base check fails.  Repeated documents
vote each for themselves; texts of any length are read whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.sources import scratch

SPACE = " \t\n\u000b\f\r"
SYMBOLS = "#*$%&|<>"
MARKS = r"!-/:-@\[-`{-~"  # all marks of ASCII
RUN = 5
ITERATIONS = 25
TOLERANCE = 1e-5
PRIOR_SHARE = 0.02
GOOD = 0.85
#: Chances of (bad, abstain, good) votes before any data, for good and for bad documents.
START = {True: (0.02, 0.18, 0.80), False: (0.30, 0.30, 0.40)}
KEEP = 0.5

#: Rule, votes bad, votes good; both over the counts of a text.
RULES = [
    ("length", "n_words < 10", "n_words >= 40"),
    ("symbols", "n_symbols > 0.3 * n_words", "n_symbols <= 0.1 * n_words"),
    ("marks", "n_marks > 0.09 * word_chars", "n_marks <= 0.07 * word_chars"),
    ("stops", "n_stops > 0.5 * n_words", "n_stops between 0.02 * n_words and 0.4 * n_words"),
    ("capitals", "n_capitals > 0.3 * word_chars", "n_capitals <= 0.15 * word_chars"),
    ("lines", "n_dup_lines > 0.5 * n_lines", "n_dup_lines <= 0.2 * n_lines"),
    ("repeats", "n_repeat_words > 0.2 * n_words", "n_repeat_words <= 0.1 * n_words"),
    ("word_length", "word_chars < 2.5 * n_words or word_chars > 15 * n_words", "word_chars between 3 * n_words and 9 * n_words"),
]


def _kept_only(text: Column, characters: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{characters}]+", ""))


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of each whole text, in layers so that each array is made once."""
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACE))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(trimmed != "", F.split(trimmed, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>")).alias("w"), lines.alias("lines"),
        _kept_only(text, SYMBOLS).alias("n_symbols"), _kept_only(text, "A-Z").alias("n_capitals"), _kept_only(text, ".!?;:").alias("n_stops"),
        _kept_only(text, MARKS).alias("n_marks"),
    )
    at = lambda k: F.get("w", k)
    runs = F.transform(F.sequence(F.lit(0), F.size("w") - RUN), lambda i: F.xxhash64(*[at(i + k) for k in range(RUN)]))
    counts = ["doc_id", "n_words", "word_chars", "n_symbols", "n_capitals", "n_stops", "n_marks", "n_lines", "n_dup_lines"]
    hashed = base.select(
        "doc_id", F.size("w").alias("n_words"), F.length(F.array_join("w", "")).alias("word_chars"), "n_symbols", "n_capitals", "n_stops", "n_marks",
        F.size("lines").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"), F.when(F.size("w") >= RUN, runs).alias("h"),
    )
    # Only texts with a repeated run sort their runs; neighbours with equal hashes repeat.
    pairs = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    found = hashed.select(*counts, F.when(F.size(F.array_distinct("h")) < F.size("h"), pairs).alias("a"))
    twice = lambda x, j: F.when((F.get("a", j - 1).getField("h") == x.getField("h")) | (F.get("a", j + 1).getField("h") == x.getField("h")), x.getField("i"))
    starts = found.select(*counts, F.sort_array(F.array_compact(F.transform("a", twice))).alias("f"))
    covers = F.transform("f", lambda x, j: F.least(F.lit(RUN), F.coalesce(F.get("f", j + 1) - x, F.lit(RUN))))
    total = F.aggregate(covers, F.lit(0), lambda a, x: a + x)
    return starts.select("doc_id", *[F.col(c).cast("long").alias(c) for c in counts[1:]], F.coalesce(total, F.lit(0)).cast("long").alias("n_repeat_words"))


def votes() -> list[Column]:
    """Each rule's vote: -1 bad, 0 abstains, 1 good."""
    return [F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0).alias(f"v_{name}") for name, bad, good in RULES]


class Model:
    """Prior of good and, for each class and rule, the chances of (bad, abstain, good) votes."""

    def __init__(self, prior: float, chances: dict[bool, list[tuple[float, float, float]]]):
        self.prior, self.chances = prior, chances

    def posterior(self) -> Column:
        """Probability of good as a function of the vote columns."""
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for (name, _, _), good, bad in zip(RULES, self.chances[True], self.chances[False], strict=True):
            weight = [math.log(g / b) for g, b in zip(good, bad, strict=True)]
            weight[0], weight[2] = min(weight[0], 0.0), max(weight[2], 0.0)
            vote = F.col(f"v_{name}")
            odds = odds + F.when(vote == -1, weight[0]).when(vote == 0, weight[1]).otherwise(weight[2])
        return 1 / (1 + F.exp(-odds))


def estimate(patterns: DataFrame) -> Model:
    """Expectation-maximisation over ``(votes, count)``."""
    model = Model(GOOD, {c: [START[c]] * len(RULES) for c in START})
    for _ in range(ITERATIONS):
        weighted = patterns.withColumn("good", F.col("count") * model.posterior())
        cell = [F.sum(F.when(F.col(f"v_{name}") == v, F.col(c)).otherwise(0.0)) for name, _, _ in RULES for v in (-1, 0, 1) for c in ("good", "count")]
        total, good, *cells = weighted.agg(F.sum("count"), F.sum("good"), *cell).first()
        if not total:
            return model
        held = {True: good, False: total - good}
        chances: dict[bool, list[tuple[float, float, float]]] = {}
        for kind in held:
            pseudo = PRIOR_SHARE * total * (GOOD if kind else 1 - GOOD) + 1
            rows = []
            for j in range(len(RULES)):
                seen = [cells[6 * j + 2 * v] if kind else cells[6 * j + 2 * v + 1] - cells[6 * j + 2 * v] for v in range(3)]
                rows.append(tuple((x + pseudo * s) / (held[kind] + pseudo) for x, s in zip(seen, START[kind], strict=True)))
            chances[kind] = rows
        pseudo = PRIOR_SHARE * total + 1
        prior = (good + pseudo * GOOD) / (total + pseudo)
        change = abs(prior - model.prior) + sum(abs(a - b) for k in chances for x, y in zip(chances[k], model.chances[k], strict=True) for a, b in zip(x, y, strict=True))
        model = Model(prior, chances)
        if change < TOLERANCE:
            break
    return model


def judge(docs: DataFrame, keep: float = KEEP) -> DataFrame:
    """Counts, votes, ``posterior``, ``base_failed`` and ``kept`` of every row."""
    voted = scratch.materialise(measure(docs).select("*", *votes()), "votes")
    patterns = scratch.materialise(voted.groupBy(*[f"v_{name}" for name, _, _ in RULES]).count(), "patterns")
    failed = F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words")
    out = voted.withColumn("posterior", estimate(patterns).posterior()).withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= keep))
