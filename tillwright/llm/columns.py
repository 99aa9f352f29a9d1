"""Column helpers shared by the native operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A plain column expression that is used inside a lambda is computed again for
    every element; as the argument of an outer lambda it is a bound variable.
    """
    return F.transform(F.array(value), body)[0]


def word_array(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def word_count(text: Column) -> Column:
    """Number of words without keeping them: pieces between gaps less the empty ends."""
    pieces = F.split(F.coalesce(text, F.lit("")), GAP)
    return let(pieces, lambda p: F.size(p) - (F.get(p, F.lit(0)) == "").cast("int")
               - ((F.size(p) > 1) & (F.get(p, F.size(p) - 1) == "")).cast("int")).cast("long")


def unit_draw(*parts: Column) -> Column:
    """A number in (0, 1) that depends on ``parts`` only: 52 bits of an MD5 digest.

    MD5 and not Spark's own hash, so that any other engine can repeat the draw.
    """
    return (draw_bits(*parts).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def draw_bits(*parts: Column) -> Column:
    digest = F.md5(F.concat_ws("/", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until it clashes with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
