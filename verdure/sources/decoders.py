"""Decode the text forms in which exported columns arrive."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from verdure.sources.catalog import ADDRESS, MONEY


def decode_address(text: Column) -> Column:
    """``(60005,Port,"Sea lane, 14",)`` to a struct.

    An empty part is NULL, ``""`` is an empty text; inside quotes a quote and a
    backslash are doubled.
    """
    inner = F.substring(text, F.lit(2), F.length(text) - 2)
    schema = ", ".join(f"{part} string" for part in ADDRESS.names)
    # A zero character, which no stored text has, tells empty texts from NULLs.
    parts = F.from_csv(inner, schema, {"escape": '"', "emptyValue": "\0"})

    def plain(part: Column) -> Column:
        single = F.replace(part, F.lit("\\\\"), F.lit("\\"))
        return F.replace(single, F.lit("\0"), F.lit(""))

    address = F.struct(*[plain(parts[part]).alias(part) for part in ADDRESS.names])
    return F.when(text.isNotNull(), address)


def decode_money(text: Column) -> Column:
    """``5 000,00 ?`` to a decimal; signs, blanks and currency marks go away."""
    digits = F.regexp_replace(text, "[^0-9,-]", "")
    return F.replace(digits, F.lit(","), F.lit(".")).cast(MONEY)


def decode_binary(text: Column) -> Column:
    r"""``\x0030`` to bytes."""
    return F.unhex(F.substring(text, F.lit(3), F.length(text)))
