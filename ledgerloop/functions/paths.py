"""Cycle paths, as arrays of account ids (open: the first account is not repeated)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloop.functions.text import strip

ARROW = "->"

_ITEM = r"""('[^']*'|"[^"]*"|[^\s,'"\[\]()]+)"""
_LIST = rf"^\[\s*({_ITEM}(\s*,\s*{_ITEM})*\s*,?)?\s*\]$"
_TUPLE = rf"^\(\s*({_ITEM}\s*,(\s*{_ITEM}\s*,)*(\s*{_ITEM})?)?\s*\)$"


def close(path: Column) -> Column:
    """Repeat the first account at the end."""
    return F.concat(path, F.slice(path, 1, 1))


def display(path: Column) -> Column:
    """'A -> B -> A' for an open path [A, B]."""
    return F.concat_ws(" -> ", close(path))


def rotate(items: Column, steps: Column) -> Column:
    """Array rotated left by `steps` (0 <= steps < size)."""
    return F.concat(
        F.slice(items, steps + 1, F.size(items) - steps), F.slice(items, F.lit(1), steps)
    )


def canonical_rotation(path: Column) -> Column:
    """The same cycle starting at its smallest account; the direction stays."""
    start = F.array_position(path, F.array_min(path)).cast("int") - 1
    return F.when(F.size(path) > 0, rotate(path, start)).otherwise(path)


def _without_empty(items: Column) -> Column:
    return F.filter(items, lambda x: x != "")


def parse_path(c: Column) -> Column:
    """Accounts of a path text, in order; null and blank texts give an empty array.

    Three shapes are read: a list or tuple literal, arrow-separated and comma-separated text.
    """
    text = strip(c)
    quoted = F.regexp_extract_all(
        text, F.lit(r"""'([^']*)'|"([^"]*)"|[^\s,'"\[\]()]+"""), F.lit(0)
    )
    literal = F.transform(quoted, lambda x: strip(F.btrim(x, F.lit("'\""))))
    arrows = F.transform(F.split(text, ARROW), lambda x: F.btrim(strip(x), F.lit("'\"")))
    commas = F.transform(F.split(text, ","), lambda x: F.btrim(strip(x), F.lit("'\"[]")))
    return (
        F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>"))
        .when(text.rlike(_LIST) | text.rlike(_TUPLE), _without_empty(literal))
        .when(F.contains(text, F.lit(ARROW)), _without_empty(arrows))
        .otherwise(_without_empty(commas))
    )


def cycle_length(path: Column) -> Column:
    """Number of different accounts."""
    return F.size(F.array_distinct(path))


def hops(path: Column) -> Column:
    """Array of (source, target) steps of a path, closed if it is open; empty below two nodes."""
    closed = F.when(F.element_at(path, 1) == F.element_at(path, -1), path).otherwise(close(path))
    steps = F.zip_with(
        F.slice(closed, F.lit(1), F.size(closed) - 1),
        F.slice(closed, F.lit(2), F.size(closed) - 1),
        lambda a, b: F.struct(a.alias("source"), b.alias("target")),
    )
    return F.when(F.size(path) >= 2, steps).otherwise(
        F.array().cast("array<struct<source:string,target:string>>")
    )
