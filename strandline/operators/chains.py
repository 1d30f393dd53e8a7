"""Chains of people named in a text, and what follows from their order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text

_SPAN = "array<struct<name:string,position:int,method:string>>"


def english_spans(isnad: Column) -> Column:
    """Names between delimiters; the position is the piece's place, so gaps may occur; no method."""
    named = F.transform(F.split(isnad, text.ENGLISH_DELIMITERS), lambda p, i: F.struct(text.clean_name(p).alias("name"), i.alias("position"), F.lit(None).cast("string").alias("method")))
    return F.filter(named, lambda s: s["name"].isNotNull())


def arabic_spans(isnad: Column) -> Column:
    """The name before the first phrase, then one after each phrase; blank ones take no position. Without phrases, the text."""
    bound = F.struct(isnad.alias("isnad"), text.transmission_phrases(isnad).alias("phrases"))
    return F.get(F.transform(F.array(bound), lambda b: _cut_at(b["isnad"], b["phrases"])), 0)


def _cut_at(isnad: Column, phrases: Column) -> Column:
    whole = text.normalize_arabic(isnad)
    alone = F.when(whole != "", F.array(F.struct(whole.alias("name"), F.lit(None).cast("string").alias("method"))))

    def cut(start: Column, end: Column) -> Column:
        return text.clean_name(text.normalize_arabic(F.substring(isnad, start + 1, F.greatest(end - start, F.lit(0)))))

    first = F.struct(cut(F.lit(0), F.get(phrases, 0)["start"]).alias("name"), F.lit(None).cast("string").alias("method"))
    rest = F.transform(phrases, lambda p, i: F.struct(cut(p["end"], F.coalesce(F.get(phrases, i + 1)["start"], F.length(isnad))).alias("name"), p["label"].alias("method")))
    found = F.when(F.size(phrases) > 0, F.concat(F.array(first), rest)).otherwise(F.coalesce(alone, F.array().cast("array<struct<name:string,method:string>>")))
    named = F.filter(found, lambda s: s["name"].isNotNull())
    return F.transform(named, lambda s, i: F.struct(s["name"].alias("name"), i.alias("position"), s["method"].alias("method")))


def spans(isnad: Column, lang: str) -> Column:
    found = arabic_spans(isnad) if lang == "ar" else english_spans(isnad)
    return F.when(text.strip(F.coalesce(isnad, F.lit(""))) != "", found.cast(_SPAN)).otherwise(F.array().cast(_SPAN))


def mentions(hadiths: DataFrame, langs: Sequence[str]) -> DataFrame:
    """One row for each name in the chain of each hadith and language, with ids that later runs give again."""
    found = []
    for lang in langs:
        isnad = F.coalesce(F.col(f"isnad_raw_{lang}"), F.col(f"full_text_{lang}")) if len(langs) == 1 else F.col(f"isnad_raw_{lang}")
        one = hadiths.select("source_id", "source_corpus", F.explode(spans(isnad, lang)).alias("s"))
        name = F.col("s.name")
        found.append(
            one.select(
                F.concat_ws(":", "source_id", F.lit(lang), "s.position").alias("mention_id"), F.col("source_id").alias("source_hadith_id"), "source_corpus",
                F.col("s.position").alias("position_in_chain"), (name if lang == "ar" else F.lit(None).cast("string")).alias("name_ar"), (name if lang == "en" else F.lit(None).cast("string")).alias("name_en"),
                text.normalize_arabic(name).alias("name_ar_normalized"), F.col("s.method").alias("transmission_method"),
            )
        )
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


#: Fixed value: corpora in the order in which their mentions are taken, with the language of their chains.
CORPUS_ORDER = (("sanadset", None), ("lk", None), ("open_hadith", "ar"), ("thaqalayn", "ar"), ("fawaz", "en"), ("sunnah", "en"))


def consolidate(hadiths: dict[str, DataFrame], extracted: dict[str, DataFrame]) -> DataFrame:
    """Mentions of all corpora in one table: those that parsing gave, else extracted from chains, in the corpora's order."""
    parts = []
    for order, (corpus, lang) in enumerate(CORPUS_ORDER):
        part = extracted.get(corpus) if lang is None else mentions(hadiths[corpus], (lang,)) if corpus in hadiths else None
        if part is not None:
            parts.append(
                part.select(
                    F.lit(order).alias("src_ord"), "mention_id", F.col("source_hadith_id").alias("hadith_id"), "source_corpus", "position_in_chain",
                    F.coalesce("name_ar", "name_en").alias("name_raw"), F.col("name_ar_normalized").alias("name_normalized"),
                    F.lit(None).cast("string").alias("canonical_narrator_id"), "transmission_method", F.lit(None).cast("float").alias("confidence"),
                )
            )
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def pairs(chain: DataFrame, key: str, order: Sequence[str], member: str) -> DataFrame:
    """Neighbours in each chain after members without an identity are left out: (key, from_id, to_id, and order[0] of the first)."""
    ordered = Window.partitionBy(key).orderBy(*order)
    following = chain.where(F.col(member).isNotNull()).withColumn("to_id", F.lead(member).over(ordered))
    return following.where("to_id IS NOT NULL").select(key, F.col(member).alias("from_id"), "to_id", F.col(order[0]).alias("position"))


def ordered_ids(chain: DataFrame, key: str, order: Sequence[str], member: str) -> DataFrame:
    """Members of each chain as a list in order; members without an identity are left out."""
    gathered = F.array_sort(F.collect_list(F.when(F.col(member).isNotNull(), F.struct(*order, F.col(member).alias("__member")))))
    return chain.groupBy(key).agg(F.transform(gathered, lambda s: s["__member"]).alias("member_ids"))


def first_member(chain: DataFrame, key: str, order: Sequence[str], member: str) -> DataFrame:
    """The earliest member with an identity of each chain."""
    known = chain.where(F.col(member).isNotNull())
    return known.groupBy(key).agg(F.min_by(member, F.struct(*order)).alias("first_id"))
