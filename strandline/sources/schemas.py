"""Schemas of staging, resolution and graph tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns of the tables, their types, and which must not be null.
HADITHS = """
    source_id string NOT NULL, source_corpus string NOT NULL, collection_name string NOT NULL, book_number int, chapter_number int, hadith_number int,
    matn_ar string, matn_en string, isnad_raw_ar string, isnad_raw_en string, full_text_ar string, full_text_en string, grade string, chapter_name_ar
    string, chapter_name_en string, sect string NOT NULL
"""
MENTIONS = """
    mention_id string NOT NULL, source_hadith_id string NOT NULL, source_corpus string NOT NULL, position_in_chain int NOT NULL, name_ar string, name_en
    string, name_ar_normalized string, transmission_method string
"""
BIOS = """
    bio_id string NOT NULL, source string NOT NULL, name_ar string, name_en string, name_ar_normalized string, name_en_normalized string, kunya string,
    nisba string, laqab string, birth_year_ah int, death_year_ah int, birth_location string, death_location string, generation string, gender string,
    trustworthiness string, bio_text string, external_id string
"""
COLLECTIONS = """
    collection_id string NOT NULL, name_ar string, name_en string NOT NULL, compiler_name string, compilation_year_ah int, sect string NOT NULL,
    total_hadiths int, source_corpus string NOT NULL
"""
NETWORK_EDGES = """
    from_narrator_name string NOT NULL, to_narrator_name string NOT NULL, hadith_id string, source string NOT NULL, from_external_id string,
    to_external_id string
"""
RESOLVED = """
    mention_id string NOT NULL, hadith_id string NOT NULL, source_corpus string NOT NULL, position_in_chain int NOT NULL, name_raw string, name_normalized
    string, canonical_narrator_id string, transmission_method string, confidence float
"""
CANONICAL = """
    canonical_id string NOT NULL, name_ar string, name_en string, name_ar_normalized string, aliases array<string>, birth_year_ah int, death_year_ah int,
    generation string, gender string, trustworthiness string, source_ids array<string>, external_id string, mention_count int
"""
AMBIGUOUS = """
    mention_id string NOT NULL, mention_text string NOT NULL, source_corpus string NOT NULL, candidate_1_id string, candidate_1_name string,
    candidate_1_score float, candidate_1_stage string, candidate_2_id string, candidate_2_name string, candidate_2_score float, candidate_2_stage string,
    candidate_3_id string, candidate_3_name string, candidate_3_score float, candidate_3_stage string
"""
PARALLELS = """
    hadith_id_a string NOT NULL, hadith_id_b string NOT NULL, similarity_score float NOT NULL, variant_type string NOT NULL, cross_sect boolean NOT NULL
"""
MERGE_LOG = """
    canonical_id string NOT NULL, mention_id string NOT NULL, mention_text string, merge_stage string NOT NULL, score float NOT NULL
"""
TOPICS = """
    source_id string NOT NULL, topic_1 string, topic_1_score float, topic_2 string, topic_2_score float, topic_3 string, topic_3_score float
"""
NODES = "label string NOT NULL, id string NOT NULL, props string NOT NULL"
EDGES = """
    label string NOT NULL, src_id string NOT NULL, src_label string NOT NULL, dst_id string NOT NULL, dst_label string NOT NULL, props string NOT NULL
"""
POINTER = """
    batch_id string NOT NULL, source string NOT NULL, b2_path string NOT NULL, timestamp timestamp, record_count int NOT NULL
"""

TABLES = {
    "hadiths": HADITHS, "narrator_mentions": MENTIONS, "narrators_bio": BIOS, "collections": COLLECTIONS, "network_edges": NETWORK_EDGES,
    "narrator_mentions_resolved": RESOLVED, "narrators_canonical": CANONICAL, "ambiguous_narrators": AMBIGUOUS, "parallel_links": PARALLELS,
    "merge_log": MERGE_LOG, "hadith_topics": TOPICS, "nodes": NODES, "edges": EDGES, "pointer": POINTER,
}

#: Labels of the graph, and the properties that each may carry.
NODE_PROPS = {
    "Narrator": "name_ar name_en name_ar_normalized transmission_method aliases birth_year_ah death_year_ah generation gender trustworthiness source_ids external_id mention_count in_degree out_degree betweenness_centrality pagerank community_id",
    "Hadith": "matn_ar matn_en isnad_raw_ar isnad_raw_en grade grade_normalized source_corpus sect collection_name chapter_name_ar chapter_name_en topic_1 topic_2 topic_3",
    "Collection": "name_ar name_en compiler_name compilation_year_ah sect total_hadiths source_corpus",
    "Chain": "hadith_id chain_index chain_length is_complete narrator_ids",
    "Grading": "hadith_id grade grade_normalized scholar_name",
    "HistoricalEvent": "name_en name_ar year_start_ah year_end_ah type",
    "Location": "name_en name_ar region lat lon",
}
EDGE_PROPS = {
    "TRANSMITTED_TO": "position_in_chain hadith_id",
    "NARRATED": "",
    "APPEARS_IN": "book_number chapter_number hadith_number_in_book",
    "STUDIED_UNDER": "source",
    "PARALLEL_OF": "similarity_score variant_type cross_sect",
    "GRADED_BY": "",
    "ACTIVE_DURING": "",
    "BASED_IN": "",
}
NODE_LABELS, EDGE_LABELS = tuple(NODE_PROPS), tuple(EDGE_PROPS)


def schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[table])


def conform(df: DataFrame, table: str, more: tuple[str, ...] = ()) -> DataFrame:
    """Exactly the table's columns, in order and cast; missing ones are null. ``more``: columns of ``df`` that stay as they are."""

    def column(f: T.StructField) -> Column:
        return (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)

    return df.select(*(column(f) for f in schema(table)), *more)


def required(table: str) -> list[str]:
    return [f.name for f in schema(table) if not f.nullable]


def drop_incomplete(df: DataFrame, table: str) -> DataFrame:
    """Without rows that lack a required column."""
    return df.dropna(subset=[c for c in required(table) if c in df.columns])
