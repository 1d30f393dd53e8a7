"""Lenient casts: null instead of an error, as raw sources need."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip


def safe_int(value: Column) -> Column:
    """The number written in a string, cut to an int; null if it isn't one or doesn't fit."""
    number = strip(value.cast("string")).try_cast("double")
    return F.when(number.between(-2147483648.0, 2147483647.0), number.try_cast("int"))


def safe_str(value: Column) -> Column:
    """Stripped; empty, 'nan' and 'none' in any case become null."""
    text = strip(value.cast("string"))
    return F.when(~F.lower(text).isin("", "nan", "none"), text)


def first_truthy(*values: Column, numeric: bool = False) -> Column:
    """The first value that is neither null nor empty (nor zero)."""
    return F.coalesce(*(F.nullif(v, F.lit(0 if numeric else "")) for v in values))


def json_or_scalar(values: Column) -> Column:
    """A list of one as its value, longer lists as JSON, none as null."""
    kept = F.filter(values, lambda v: v.isNotNull() & (v != ""))
    return F.when(F.size(kept) == 1, F.get(kept, 0)).when(F.size(kept) > 1, F.to_json(kept))


def language_body(bodies: Column, lang: str) -> Column:
    """The body of the first entry (lang, body) in a language."""
    return F.get(F.filter(bodies, lambda b: b["lang"] == lang), 0)["body"]
