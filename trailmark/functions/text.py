"""Names, prefixes and fields in text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def prefix_group(name: Column, prefixes: list[tuple[str, str]], other: str) -> Column:
    """Group of the first prefix that a name starts with."""
    out = None
    for prefix, group in prefixes:
        hit = F.startswith(name, F.lit(prefix))
        out = out.when(hit, group) if out is not None else F.when(hit, group)
    return out.otherwise(other) if out is not None else F.lit(other)


def terminated(raw: Column) -> Column:
    """What stands before the first NUL, without spaces at its end."""
    return F.rtrim(F.substring_index(raw, "\0", 1))


def dotted(json: Column, path: str) -> Column:
    """The value at a dotted path of a JSON text."""
    return F.get_json_object(json, "$." + path)


def number_at_end(name: Column) -> Column:
    """The number a name ends with, for natural order; null where there is none."""
    return F.nullif(F.regexp_extract(name, "([0-9]+)$", 1), F.lit("")).cast("int")
