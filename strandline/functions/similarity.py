"""String and vector similarity as column expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

SUNNI, SHIA = ("lk", "sanadset", "sunnah", "fawaz", "open_hadith"), ("thaqalayn",)


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence: one fold over a, with a row of the table as the state."""
    row = F.transform(F.sequence(F.lit(0), F.length(b)), lambda j: F.lit(0))

    def next_row(previous: Column, c: Column) -> Column:
        def cell(done: Column, j: Column) -> Column:
            same = F.substring(b, j, F.lit(1)) == c
            value = F.when(same, F.get(previous, j - 1) + 1).otherwise(F.greatest(F.get(previous, j), F.get(done, j - 1)))
            return F.concat(done, F.array(value))

        start = F.array(F.lit(0))
        return F.when(F.length(b) > 0, F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(b), F.lit(1))), start, cell)).otherwise(previous)

    return F.element_at(F.aggregate(F.split(a, ""), row, next_row), -1)


def lcs_bits(a: str, b: str) -> int:
    """Length of the longest common subsequence by bits of whole rows of the table: one addition for each character of b."""
    places: dict[str, int] = {}
    for k, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def indel_ratio_batched(a: Column, b: Column) -> Column:
    """As ``indel_ratio``, in Arrow batches: for joins that compare many pairs."""

    @F.pandas_udf("double")
    def ratio(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([200.0 * lcs_bits(s, t) / (len(s) + len(t)) if s or t else 100.0 for s, t in zip(x, y, strict=True)])

    return ratio(a, b)


def indel_ratio(a: Column, b: Column) -> Column:
    """100 * 2 * LCS / (length a + length b); 100 for two empty strings."""
    total = F.length(a) + F.length(b)
    return F.when(total == 0, F.lit(100.0)).otherwise(lcs_length(a, b) * F.lit(200.0) / total)


def ratio_bound(a: Column, b: Column) -> Column:
    """No indel ratio of strings with these lengths is higher."""
    return F.lit(200.0) * F.least(F.length(a), F.length(b)) / F.greatest(F.length(a) + F.length(b), F.lit(1))


def within_distance(a: Column, b: Column, most: int = 2) -> Column:
    """Whether the Levenshtein distance is at most ``most``."""
    return F.levenshtein(a, b, most) >= 0


def inner_product(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def tier(score: Column, verbatim: float = 0.9, close: float = 0.8) -> Column:
    return F.when(score >= verbatim, "verbatim").when(score >= close, "close_paraphrase").otherwise("thematic")


def cross_sect(a: Column, b: Column) -> Column:
    return (a.isin(*SUNNI) & b.isin(*SHIA)) | (a.isin(*SHIA) & b.isin(*SUNNI))


def round_even(value: Column, places: int) -> Column:
    return F.bround(value, places)


def year_window(year: Column, width: int = 30) -> tuple[Column, Column]:
    """From ``width`` years before, year 1 at the earliest, to ``width`` after."""
    return F.greatest(F.lit(1), year - width), year + width


def plausible_gap(a: Column, b: Column, least: int = 15, most: int = 80) -> Column:
    return F.abs(a - b).between(least, most)


def deviation_percent(actual: Column, expected: Column) -> Column:
    return F.when(expected != 0, F.abs(actual - expected) * 100.0 / expected)
