"""URL filter: rules of host and path, else logistic regression on hashed character n-grams.

``host`` is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end,
with A-Z lower-cased; ``path`` follows up to ``?``, ``#`` or the end.  A rule
names a host and a path; it fits that host and all its subdomains where the
path starts with the rule's, and the longest fitting rule decides.

Other URLs are judged by the model.  Host and path each give character 3- to
5-grams (with ``^`` and ``$`` at the ends) whose hashes pick weights out of
``BUCKETS``; the score is the logistic of an intercept and the mean of the
weights of the grams, scaled by the square root of their number.  Gradient
descent over a small labelled table, one aggregation a step, fits the weights;
the intercept is a stated prior, of which a table written by hand says nothing.
The table is the operator's argument, its size the caller's choice, and the
weights have a fixed number.  Scoring is one pass without a shuffle.

A null URL and one without ``://`` have empty host and path, no n-grams, and the
verdict of the prior: allow.  Repeated pages are judged each for itself.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm import labelled_urls
from pageloom.sources import scratch

BUCKETS = 1 << 12
SIZES = (3, 4, 5)
STEPS, RATE, DECAY = 60, 16.0, 1e-3
BLOCK = 0.5
PRIOR = 0.2  # share of addresses to block where nothing else is known
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Verdict, host and path of each rule.
Rule = tuple[str, str, str]


def host_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL, both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*+", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*+([^?#]*+)", 1)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule as ``host/path`` and its verdict; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name, verdict = F.when(fits, rule_host + rule_path).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def _grams(text: str, chars: str, mark: str) -> Column:
    """Buckets of all character n-grams of a column of characters; linear in its length."""

    def of(n: int) -> Column:
        def gram(c: Column, i: Column) -> Column:
            rest = [F.get(chars, i + k) for k in range(1, n)]
            return F.when(rest[-1].isNotNull(), F.pmod(F.xxhash64(F.lit(mark), F.concat(c, *rest)), F.lit(BUCKETS)).cast("int"))

        return F.array_compact(F.transform(chars, gram))

    return F.when(F.col(text) != "", F.concat(*[of(n) for n in SIZES])).otherwise(F.array().cast("array<int>"))


def with_grams(urls: DataFrame) -> DataFrame:
    """Adds ``host``, ``path`` and ``grams`` to rows with a ``url``."""
    host, path = host_path(F.col("url"))
    kept = [F.col(c) for c in urls.columns]
    chars = [F.split(F.concat(F.lit("^"), c, F.lit("$")), "").alias(f"{c}_chars") for c in ("host", "path")]
    parts = urls.select(*kept, host.alias("host"), path.alias("path")).select(*kept, "host", "path", *chars)
    return parts.select(*kept, "host", "path", F.concat(_grams("host", "host_chars", "host"), _grams("path", "path_chars", "path")).alias("grams"))


class Model:
    """Intercept and one weight per bucket."""

    def __init__(self, intercept: float, weights: list[float]):
        self.intercept, self.weights = intercept, weights

    def score(self, grams: Column) -> Column:
        """Probability of block."""
        table = F.expr("array(" + ", ".join(f"{w!r}D" for w in self.weights) + ")")
        total = F.aggregate(grams, F.lit(0.0), lambda a, g: a + F.get(table, g))
        return 1 / (1 + F.exp(-(F.lit(self.intercept) + total / F.sqrt(F.greatest(F.size(grams), F.lit(1))))))


def train(labelled: DataFrame) -> Model:
    """Fit on ``(url, label)``, label 1 for block; other rows are left out."""
    rows = labelled.select(F.col("url").alias("url"), F.col("label").cast("int").alias("label")).filter("url is not null and label in (0, 1)")
    rows = scratch.materialise(with_grams(rows).select("label", "grams"), "urls")
    n, ones = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    model = Model(math.log(PRIOR / (1 - PRIOR)), [0.0] * BUCKETS)
    if not 0 < ones < n:
        return model
    norm = F.sqrt(F.greatest(F.size("grams"), F.lit(1)))
    for _ in range(STEPS):
        wrong = rows.select((F.col("label") - model.score(F.col("grams"))).alias("wrong"), norm.alias("norm"), F.explode("grams").alias("g"))
        slopes = wrong.groupBy("g").agg(F.sum(F.col("wrong") / F.col("norm")).alias("d"))
        weights = [w * (1 - DECAY) for w in model.weights]
        for g, d in slopes.collect():  # at most one row per bucket
            weights[g] += RATE * d / n
        model = Model(model.intercept, weights)
    return model


def default_table(spark: SparkSession) -> DataFrame:
    """The labelled URLs that come with the package."""
    rows = [(u, 1) for u in labelled_urls.BLOCK] + [(u, 0) for u in labelled_urls.ALLOW]
    return spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{u}', {y})" for u, y in rows) + " AS t(url, label)")


def judge(pages: DataFrame, rules: list[Rule], model: Model, block: float = BLOCK) -> DataFrame:
    """``(page_id, host, path, rule, verdict, score)`` of every page."""
    parts = with_grams(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("url")))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    scored = parts.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("by_rule"), model.score(F.col("grams")).alias("score"))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("by_rule", F.when(F.col("score") >= block, "block").otherwise("allow")).alias("verdict"), "score")
