"""Main domains (public suffix plus one label) and filters built on them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions.urls import host, with_url_parts


def _candidates(name: Column) -> Column:
    """``a.b.c`` -> [a.b.c, b.c, c]: possible suffixes, longest first."""
    labels = F.split(name, r"\.", -1)
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))


def _with_label(name: Column, suffix: Column) -> Column:
    """``suffix`` plus the label before it; the whole name without a suffix."""
    before = F.substr(name, F.lit(1), F.length(name) - F.length(suffix) - 1)
    return F.when(suffix.isNull(), name).otherwise(
        F.concat(F.substring_index(before, ".", -1), F.lit("."), F.right(name, F.length(suffix))))


def main_domain(url_host: Column, suffixes: Sequence[str]) -> Column:
    """Main domain of a host for a suffix list known to the driver.

    The list becomes a hashed ``IN`` set, so this needs neither a join nor a
    shuffle.  Rules ``*.x`` and ``!y.x`` have their usual meaning.
    """
    rules = sorted({s.strip().lower() for s in suffixes})
    exact = [r for r in rules if r[:1] not in "*!"]
    wild = [r[2:] for r in rules if r.startswith("*.")]
    except_ = [r[1:] for r in rules if r.startswith("!")]

    def is_suffix(c: Column) -> Column:
        ok = c.isin(*exact)
        if wild:
            parent = F.when(F.contains(c, F.lit(".")), F.substr(c, F.instr(c, ".") + 1))
            ok = ok | F.coalesce(parent.isin(*wild), F.lit(False))
        if except_:
            ok = (ok & ~c.isin(*except_)) | c.isin(*[e.split(".", 1)[1] for e in except_])
        return ok

    longest = F.get(F.filter(_candidates(F.lower(url_host)), is_suffix), F.lit(0))
    return F.transform(F.array(longest), lambda s: _with_label(url_host, s))[0]


def _rules(suffixes: DataFrame) -> DataFrame:
    """``(name, kind)``: plain suffixes, names below which every label is one, and exceptions with the suffix they leave."""
    rule = suffixes.select(F.lower(F.trim("suffix")).alias("r")).filter("r <> ''")
    kind = F.when(F.startswith("r", F.lit("*.")), F.array(F.struct(F.substr("r", F.lit(3)).alias("name"), F.lit("wild").alias("kind"))))
    kind = kind.when(F.startswith("r", F.lit("!")), F.array(
        F.struct(F.substr("r", F.lit(2)).alias("name"), F.lit("except").alias("kind")),
        F.struct(F.substr("r", F.instr("r", ".") + 1).alias("name"), F.lit("left").alias("kind"))))
    kind = kind.otherwise(F.array(F.struct(F.col("r").alias("name"), F.lit("plain").alias("kind"))))
    return rule.select(F.inline(kind)).distinct()


def suffix_match(hosts: DataFrame, suffixes: DataFrame) -> DataFrame:
    """``(host) -> (host, suffix, main_domain)`` by joining the suffixes of distinct hosts with the rules.

    The rules are those of :func:`main_domain`, for a list of any length.
    """
    names = hosts.select("host").distinct()
    own = names.select("host", F.explode(_candidates(F.lower("host"))).alias("suffix"))
    parent = F.when(F.contains("suffix", F.lit(".")), F.substr("suffix", F.instr("suffix", ".") + 1))
    keys = own.select("host", "suffix", F.col("suffix").alias("name"), F.lit(False).alias("above")).unionAll(
        own.select("host", "suffix", parent.alias("name"), F.lit(True)).filter("name is not null"))
    fits = keys.join(_rules(suffixes), "name").filter("above = (kind = 'wild')").groupBy("host", "suffix").agg(
        F.bool_or(F.col("kind").isin("plain", "wild")).alias("listed"), F.bool_or(F.col("kind") == "except").alias("excepted"),
        F.bool_or(F.col("kind") == "left").alias("left"))
    longest = fits.filter("(listed and not excepted) or left").groupBy("host").agg(F.max_by("suffix", F.length("suffix")).alias("suffix"))
    return names.join(longest, "host", "left").withColumn("main_domain", _with_label(F.col("host"), F.col("suffix")))


def with_main_domain(df: DataFrame, url_col: str, suffixes: DataFrame | Sequence[str], out: str = "main_domain") -> DataFrame:
    """Add the main domain of ``url_col``.

    A sequence travels in the expression; a table, of any length, is matched once
    per distinct host and joined back.  Both read the rules alike.
    """
    listed = None if isinstance(suffixes, DataFrame) else list(suffixes)
    df = with_url_parts(df, url_col, "__d_", ["netloc"]).withColumn("__host", host(F.col("__d_netloc")))
    if listed is not None:
        done = df.withColumn(out, main_domain(F.col("__host"), listed) if listed else F.col("__host"))
    else:
        found = suffix_match(df.select(F.col("__host").alias("host")), suffixes).select(
            F.col("host").alias("__host"), F.col("main_domain").alias(out))
        done = df.join(found, "__host", "left")
    return done.drop("__d_netloc", "__host")


def filter_internal(links: DataFrame, href: str = "href", domain: str = "main_domain") -> DataFrame:
    """Links whose netloc contains the main domain; relative links have none and go."""
    parts = with_url_parts(links, href, "__i_", ["netloc"])
    return parts.filter(F.instr(F.lower("__i_netloc"), F.col(domain)) > 0).drop("__i_netloc")


def exclude_external(links: DataFrame, url: str = "url", page_domain: str = "main_domain",
                     suffixes: DataFrame | Sequence[str] = ()) -> DataFrame:
    """Links that stay on the main domain of their page."""
    own = with_main_domain(links, url, suffixes, "__own")
    return own.filter(F.lower("__own") == F.lower(page_domain)).drop("__own")


def keep_same_domain(links: DataFrame, url: str, page_url: str, suffixes: DataFrame | Sequence[str]) -> DataFrame:
    """:func:`exclude_external` for links that carry the address of their page.

    Most links stay on their host, which settles them; only the others have
    their main domains compared.
    """
    listed = None if isinstance(suffixes, DataFrame) else list(suffixes)
    if not listed:
        with_page = with_main_domain(links, page_url, suffixes, "__page_domain")
        return exclude_external(with_page, url, "__page_domain", suffixes).drop("__page_domain")
    both = with_url_parts(with_url_parts(links, url, "__u_", ["netloc"]), page_url, "__p_", ["netloc"])
    own, page = (F.lower(host(F.col(c))) for c in ("__u_netloc", "__p_netloc"))
    same = (own == page) | (main_domain(own, listed) == main_domain(page, listed))
    return both.filter(same).drop("__u_netloc", "__p_netloc")


def exclude_social(links: DataFrame, social: DataFrame | Iterable[str], url: str = "url",
                   suffixes: DataFrame | Sequence[str] = ()) -> DataFrame:
    """Links that do not lead to one of the listed social-media domains."""
    if not isinstance(social, DataFrame):
        social = links.sparkSession.createDataFrame([(s,) for s in social], "domain string")
    names = social.select(F.lower("domain").alias("__social")).distinct()
    if not isinstance(suffixes, DataFrame) and not list(suffixes):
        # Without a suffix list a host belongs to every listed name it ends with.
        parts = with_url_parts(links, url, "__s_", ["netloc"]).withColumn("__host", F.lower(host(F.col("__s_netloc"))))
        listed = parts.select("__host").distinct().select("__host", F.explode(_candidates(F.col("__host"))).alias("__social"))
        return parts.join(listed.join(names, "__social", "left_semi"), "__host", "left_anti").select(*links.columns)
    own = with_main_domain(links, url, suffixes, "__own")
    return own.join(names, F.lower(own["__own"]) == names["__social"], "left_anti").drop("__own")
