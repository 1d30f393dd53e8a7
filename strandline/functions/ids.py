"""Identifiers: composed, prefixed, hashed and checked, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import collection_slug

#: Known corpora, prefixes of node kinds, and the namespace of canonical ids.
CORPORA = ("lk", "sanadset", "thaqalayn", "sunnah", "fawaz", "open_hadith", "muhaddithat", "itqan", "halimbahae", "mis", "bihar")
PREFIXES = {"Hadith": "hdt:", "Collection": "col:", "Narrator": "nar:", "Chain": "chn:", "Grading": "grd:", "HistoricalEvent": "evt:", "Location": "loc:"}
NAMESPACE = "a1b2c3d4-e5f6-7890-abcd-ef1234567890"

_REPEATED = rf"^({'|'.join(CORPORA)})(?::\1)+(?=:|$)"


def apply_prefix(value: Column, prefix: str) -> Column:
    return F.when(value.startswith(prefix), value).otherwise(F.concat(F.lit(prefix), value))


def source_id(corpus: Column | str, collection: Column, *parts: Column) -> Column:
    """corpus:collection:part...; missing parts are 0."""
    lead = F.lit(corpus) if isinstance(corpus, str) else corpus
    return F.concat_ws(":", lead, collection, *(F.coalesce(p.cast("string"), F.lit("0")) for p in parts))


def bare_source_id(value: Column) -> Column:
    """Without one node prefix, and with a repeated known corpus in front only once."""
    return F.regexp_replace(F.regexp_replace(value, "^hdt:", ""), _REPEATED, "$1")


def hadith_id(value: Column) -> Column:
    return F.concat(F.lit("hdt:"), bare_source_id(value))


def chain_id(value: Column, index: int = 0) -> Column:
    return F.when(value.startswith("chn:"), value).otherwise(F.concat(F.lit("chn:"), bare_source_id(value), F.lit(f"-{index}")))


def grading_id(value: Column) -> Column:
    return F.concat(F.lit("grd:"), bare_source_id(value))


def sha1_24(value: Column) -> Column:
    return F.substring(F.sha1(value), 1, 24)


def uuid5(name: Column, namespace: str = NAMESPACE) -> Column:
    """Version 5 UUID of a name: sha1 over namespace bytes and name, with version and variant set."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat_ws(
        "-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)),
        F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12),
    )


def canonical_id(name_normalized: Column) -> Column:
    return F.concat(F.lit("nar:"), uuid5(name_normalized))


def stream_narrator_id(name_en: Column, name_ar_normalized: Column) -> Column:
    """Identity of the streaming path: digest over the lower-cased English and the normalised Arabic name."""
    key = F.concat(F.lit("en:"), F.lower(F.trim(F.coalesce(name_en, F.lit("")))), F.lit("|ar:"), F.coalesce(name_ar_normalized, F.lit("")))
    return F.concat(F.lit("nar:"), sha1_24(key))


def stream_collection_id(name: Column) -> Column:
    return F.concat(F.lit("col:"), collection_slug(name))


def source_id_problems(value: Column) -> Column:
    """What breaks the grammar of a source id; empty if nothing does."""
    parts = F.split(value, ":")
    known = F.get(parts, 0).isin(*CORPORA)
    doubled = known & (F.get(parts, 0) == F.get(parts, 1))
    problems = F.array_compact(
        F.array(
            F.when(~known, F.lit("unknown corpus")),
            F.when(F.size(parts) < 2, F.lit("no collection segment")),
            F.when(F.exists(parts, lambda p: p == ""), F.lit("empty segment")),
            F.when(doubled, F.lit("doubled corpus")),
        )
    )
    return F.when(F.coalesce(value, F.lit("")) == "", F.array(F.lit("empty"))).otherwise(problems)
