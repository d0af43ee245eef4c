"""Small text columns: labels, file names, times, entities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageloom.functions import fixed

TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"


def depth_sheet(depth: Column) -> Column:
    """``Depth Level N``: name of a report sheet."""
    return F.concat(F.lit("Depth Level "), depth.cast("string"))


def depth_label(depth: Column) -> Column:
    """``Depth N``: label of a summary line."""
    return F.concat(F.lit("Depth "), depth.cast("string"))


def extract_depth(sheet: Column) -> Column:
    """First run of digits in a sheet name, 0 when there is none."""
    digits = F.regexp_extract(sheet, r"[0-9]+", 0)
    return F.when(digits == "", F.lit(0)).otherwise(digits.try_cast("int"))


def is_depth_sheet(sheet: Column) -> Column:
    """Sheet names that start with ``depth level`` in any case."""
    return F.startswith(F.lower(sheet), F.lit("depth level"))


def manifest_name(row_num: Column, depth: Column) -> Column:
    """``{row}_d{depth}``."""
    return F.concat(row_num.cast("string"), F.lit("_d"), depth.cast("string"))


def manifest_folder(sheet: Column, base_folder: str = fixed.BASE_FOLDER) -> Column:
    return F.concat_ws("/", F.lit(base_folder.rstrip("/")), sheet)


def site_part(site: Column) -> Column:
    """A site as one folder name; different sites stay different."""
    for char, code in (("%", "%25"), ("/", "%2F"), (":", "%3A")):
        site = F.replace(site, F.lit(char), F.lit(code))
    return site


def format_ts(ts: Column) -> Column:
    return F.date_format(ts, TIME_PATTERN)


def dims_label(width: Column, height: Column) -> Column:
    """``{width}x{height}``."""
    return F.concat(width.cast("string"), F.lit("x"), height.cast("string"))


def size_kb(size_bytes: Column) -> Column:
    return size_bytes / F.lit(1024.0)


def size_label(kb: Column) -> Column:
    """Kilobytes with two decimals; halves go to the even digit."""
    return F.format_string("%.2f", F.bround(kb, 2))


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def extension(path: Column) -> Column:
    """Lower-cased suffix with its dot; a leading dot alone is no suffix."""
    return F.lower(F.regexp_extract(basename(path), r"(?s)^\.*[^.].*(\.[^.]*)$", 1))


def has_suffix(path: Column, suffixes: tuple[str, ...]) -> Column:
    """Paths whose lower-cased form ends in one of ``suffixes``."""
    names = "|".join(s.lstrip(".") for s in suffixes)
    return F.lower(path).rlike(rf"(?s)\.(?:{names})\z")


def _code_point(digits: Column, base: int) -> Column:
    value = F.conv(digits, base, 16)
    valid = (F.length(value) <= 6) & (F.conv(digits, base, 10).cast("long").between(1, 0x10FFFF))
    return F.when(valid, F.decode(F.unhex(F.lpad(value, 8, "0")), "UTF-32")).otherwise(F.lit("�"))


_ENTITY = r"&(?:#[0-9]++|#[xX][0-9A-Fa-f]++|lt|gt|quot|apos|nbsp|amp);"


def unescape_entities(text: Column) -> Column:
    """Replace numeric character references and the basic named ones, each once and from left to right."""

    def put(ref: Column) -> Column:
        out = F.when(F.startswith(F.lower(ref), F.lit("&#x")), _code_point(F.regexp_extract(ref, "[xX]([0-9A-Fa-f]+)", 1), 16))
        out = out.when(F.startswith(ref, F.lit("&#")), _code_point(F.regexp_extract(ref, "([0-9]+)", 1), 10))
        for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("nbsp", "\u00a0")):
            out = out.when(ref == f"&{name};", char)
        return out.otherwise("&")

    def join(t: Column) -> Column:
        pieces = F.split(t, _ENTITY, -1)
        refs = F.regexp_extract_all(t, F.lit(_ENTITY), F.lit(0))
        return F.array_join(F.zip_with(pieces, refs, lambda piece, ref: F.when(ref.isNull(), piece).otherwise(F.concat(piece, put(ref)))), "")

    return F.when(F.contains(text, F.lit("&")), join(text)).otherwise(text)
