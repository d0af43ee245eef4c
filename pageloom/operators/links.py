"""Links and images out of captured pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions.labels import unescape_entities
from pageloom.functions.urls import with_image_url, with_normalized_url

# Comments, scripts and styles are matched first, so tags inside them are not
# seen.  Every loop is possessive and whatever is left open runs to the end of
# the page: one pass, no backtracking, no recursion, whatever it looks like.
_SKIPPED = r"<!--.*?(?:-->|\z)|<(?:script|style)\b.*?(?:</(?:script|style)\s*+>|\z)"
_ATTRIBUTES = r"""[^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+[^>]*+"""


def _tags(html: Column, tag: str) -> Column:
    """Every ``tag`` with its attributes, in document order.

    ``tag`` may be an alternation, to find several kinds in one pass.
    """
    name = rf"(?:{tag})(?![^\s/>])"
    pattern = rf"(?is){_SKIPPED}|<({name}{_ATTRIBUTES})>|<{name}{_ATTRIBUTES}\z"
    found = F.regexp_extract_all(html, F.lit(pattern), F.lit(1))
    return F.filter(found, lambda t: t != "")


def _attribute(tag: Column, name: str) -> Column:
    """Value of attribute ``name``, empty when it is missing."""
    skip = rf"""(?:(?!(?<![\w\-:.]){name}\s*+=)(?:"[^"]*+"|'[^']*+'|.))*+"""
    raw = F.regexp_extract(tag, rf"""(?is)^{skip}{name}\s*+=\s*+("[^"]*+"?|'[^']*+'?|[^\s>]*+)""", 1)
    quoted = F.startswith(raw, F.lit('"')) | F.startswith(raw, F.lit("'"))
    bare = F.when(quoted, F.substr(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw)
    return unescape_entities(F.trim(bare))


def _explode(pages: DataFrame, tag: str, attribute: str, keep: list[str]) -> DataFrame:
    values = F.transform(_tags(F.col("html"), tag), lambda t: _attribute(t, attribute))
    return pages.select(*keep, F.posexplode(values).alias("pos", attribute))


def extract_links(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per anchor: ``(page_id, page_url, pos, href)``.

    An anchor without ``href`` gives an empty one.  ``html`` goes no further.
    """
    pages = pages.withColumnRenamed("url", "page_url")
    return _explode(pages, "a", "href", keep or ["page_id", "page_url"])


def extract_images(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per image with a source: ``(page_id, page_url, pos, src)``."""
    pages = pages.withColumnRenamed("url", "page_url")
    return filter_image_src(_explode(pages, "img", "src", keep or ["page_id", "page_url"]))


def extract_tags(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Links and images in one pass: ``(page_id, page_url, kind, pos, value)``.

    ``kind`` is ``a`` or ``img``; ``pos`` counts within a kind.  Worth writing
    once when both are needed, as the pages are read a single time.
    """
    pages = pages.withColumnRenamed("url", "page_url")

    def values(found: Column, kind: str, attribute: str) -> Column:
        own = F.filter(found, lambda t: F.lower(F.left(t, F.lit(len(kind)))) == kind)
        return F.transform(own, lambda t, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("pos"), _attribute(t, attribute).alias("value")))

    found = F.transform(F.array(_tags(F.col("html"), "a|img")), lambda f: F.concat(values(f, "a", "href"), values(f, "img", "src")))
    return pages.select(*(keep or ["page_id", "page_url"]), F.inline(found[0]))


def split_tags(tags: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``extract_tags`` rows as links and images with a source."""
    links = tags.filter("kind = 'a'").drop("kind").withColumnRenamed("value", "href")
    images = tags.filter("kind = 'img'").drop("kind").withColumnRenamed("value", "src")
    return links, filter_image_src(images)


def filter_image_src(media: DataFrame) -> DataFrame:
    """Images that have a non-empty ``src``."""
    return media.filter(F.length("src") > 0)


def absolute_images(media: DataFrame) -> DataFrame:
    """Add ``image_url`` from ``src`` and ``page_url``."""
    return with_image_url(media)


def drop_null_urls(links: DataFrame, url: str = "url") -> DataFrame:
    """Links whose normal form exists and is not empty."""
    return links.filter(F.length(url) > 0)


def normalized_links(links: DataFrame, **options) -> DataFrame:
    """``extract_links`` rows with ``url`` = normal form of ``href``; filtered links go."""
    return with_normalized_url(links, "href", "page_url", "url", drop_filtered=True, **options)
