"""Small text functions: numeric order, paths, suffixes, decimal commas, stable numbers from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def numeric_order(c: Column) -> Column:
    """The first number in a text, to sort by; null (last) where there is none."""
    return F.nullif(F.regexp_extract(c, r"(\d+)", 1), F.lit("")).cast("long")


def normal_path(c: Column) -> Column:
    """Slashes forward and single, none at the end."""
    return F.regexp_replace(F.regexp_replace(c, r"[\\/]+", "/"), r"(?<=.)/$", "")


def base_name(c: Column) -> Column:
    """What follows the last slash."""
    return F.substring_index(normal_path(c), "/", -1)


def lower_extension(c: Column) -> Column:
    """The path with its file extension in lower case."""
    ext = F.regexp_extract(c, r"(\.[^./\\]+)$", 1)
    return F.concat(F.regexp_replace(c, r"\.[^./\\]+$", ""), F.lower(ext))


def without_visit(c: Column) -> Column:
    """A pseudonym without its visit number."""
    return F.regexp_replace(c, r"_\d+$", "")


def decimal_points(c: Column) -> Column:
    """Decimal commas between digits as points."""
    return F.regexp_replace(c, r"(\d+),(\d+)", "$1.$2")


def padded(number: Column, width: int) -> Column:
    """A number with zeros before it up to a width; longer ones stay whole."""
    digits = number.cast("string")
    return F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)


def text_number(c: Column) -> Column:
    """A stable number below 10^10 of a text: its SHA-256's first 16 hex digits, modulo."""
    head = F.conv(F.substring(F.sha2(c, 256), 1, 16), 16, 10).cast("decimal(20,0)")
    return (head % F.lit(10_000_000_000).cast("decimal(20,0)")).cast("long")


def number_key(c: Column) -> Column:
    """A join key by which '020' and '20' are one."""
    return F.when(c.rlike(r"^\d+$"), c.cast("decimal(38,0)").cast("string")).otherwise(c)


def seeded_order(seed: int | str, key: Column) -> Column:
    """A hex text by which rows are in a seeded random order, the same on every engine with MD5."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
