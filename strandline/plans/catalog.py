"""Registered queries of the engine's operators over the driver's tables, each with the same result in DuckDB's SQL.

Stand-ins for the corpus: documents are texts, lineitem and conversations are chains, customer and supplier are people, nation
is a collection, events are messages, embeddings are vectors, pages are raw pages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import casts, ids, similarity, text
from ..operators import analytics, chains, embedding, graph, matching, parallels, partners, quality, validation, vector_index
from ..sources import parsers, readers, schemas
from .lineage import cut, folder, stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return readers.parquet(spark, f"{sf_dir}/{name}.parquet")


ORDER = ("l_linenumber", "l_suppkey", "l_partkey", "l_shipdate", "l_extendedprice")
_ORDER_SQL = ", ".join(ORDER)
_PAIRS_SQL = f"""SELECT * FROM (SELECT l_orderkey, l_suppkey AS from_id, lead(l_suppkey) OVER (PARTITION BY l_orderkey ORDER BY {_ORDER_SQL}) AS to_id, l_linenumber AS position FROM lineitem) WHERE to_id IS NOT NULL"""
_EDGES_SQL = f"SELECT DISTINCT from_id AS src_id, to_id AS dst_id, position, l_orderkey FROM ({_PAIRS_SQL})"


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chains.pairs(table(spark, sf_dir, "lineitem"), "l_orderkey", ORDER, "l_suppkey")


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select(F.col("from_id").alias("src_id"), F.col("to_id").alias("dst_id"), "position", "l_orderkey").distinct()


# ---- chains and graph ----


@query(f"""WITH e AS ({_EDGES_SQL}), i AS (SELECT dst_id AS id, count(*) AS n FROM e GROUP BY 1), o AS (SELECT src_id AS id, count(*) AS n FROM e GROUP BY 1)
SELECT s_suppkey AS id, s_name, coalesce(i.n, 0) AS in_degree, coalesce(o.n, 0) AS out_degree FROM supplier LEFT JOIN i ON i.id = s_suppkey LEFT JOIN o ON o.id = s_suppkey
ORDER BY in_degree + out_degree DESC, id LIMIT 50""")
def chain_degree_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: chains to edges, edges with both ends, degrees, and the best connected."""
    people = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), "s_name")
    found = _edges(spark, sf_dir).join(people.select(F.col("id").alias("src_id")), "src_id", "left_semi").join(people.select(F.col("id").alias("dst_id")), "dst_id", "left_semi")
    return people.join(analytics.degrees(people, found), "id").orderBy((F.col("in_degree") + F.col("out_degree")).desc(), "id").limit(50)


@query(_PAIRS_SQL)
def chain_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir)


@query(f"SELECT l_orderkey, string_agg(l_suppkey::VARCHAR, ',' ORDER BY {_ORDER_SQL}) AS member_ids FROM lineitem GROUP BY 1")
def chain_ordered_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chains.ordered_ids(table(spark, sf_dir, "lineitem"), "l_orderkey", ORDER, "l_suppkey")
    return found.select("l_orderkey", F.array_join(F.col("member_ids").cast("array<string>"), ",").alias("member_ids"))


@query(f"SELECT l_orderkey, first_id FROM (SELECT l_orderkey, l_suppkey AS first_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_ORDER_SQL}) AS k FROM lineitem) WHERE k = 1")
def first_narrator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chains.first_member(table(spark, sf_dir, "lineitem"), "l_orderkey", ORDER, "l_suppkey")


@query(f"""WITH e AS ({_EDGES_SQL}) SELECT s_suppkey AS id, (SELECT count(*) FROM e WHERE dst_id = s_suppkey) AS in_degree, (SELECT count(*) FROM e WHERE src_id = s_suppkey) AS out_degree FROM supplier""")
def degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.degrees(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id")), _edges(spark, sf_dir))


@query(f"""WITH e AS ({_EDGES_SQL}), s AS (SELECT s_suppkey FROM supplier WHERE s_suppkey % 2 = 0)
SELECT src_id, dst_id, position, l_orderkey FROM e WHERE src_id IN (FROM s) AND dst_id IN (FROM s)""")
def endpoint_semijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = _with_even(spark, sf_dir)
    return good


@query(f"""WITH e AS ({_EDGES_SQL}), s AS (SELECT s_suppkey FROM supplier WHERE s_suppkey % 2 = 0)
SELECT count(*) AS missing FROM e WHERE NOT (src_id IN (FROM s) AND dst_id IN (FROM s))""")
def missing_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = _with_even(spark, sf_dir)
    return bad.agg(F.count("*").alias("missing"))


def _with_even(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    known = table(spark, sf_dir, "supplier").where("s_suppkey % 2 = 0").select(F.lit("Narrator").alias("label"), F.col("s_suppkey").alias("id"))
    links = _edges(spark, sf_dir).withColumn("src_label", F.lit("Narrator")).withColumn("dst_label", F.lit("Narrator"))
    return tuple(x.select("src_id", "dst_id", "position", "l_orderkey") for x in graph.with_endpoints(links, known))  # type: ignore[return-value]


@query("SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def orphan_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = table(spark, sf_dir, "orders").select(F.lit("Order").alias("label"), F.col("o_orderkey").alias("id"), "o_custkey")
    links = table(spark, sf_dir, "lineitem").select(F.lit("Order").alias("src_label"), F.col("l_orderkey").alias("src_id"), F.lit("Supplier").alias("dst_label"), F.col("l_suppkey").alias("dst_id"))
    return graph.orphans(nodes, links).select(F.col("id").alias("o_orderkey"), "o_custkey")


@query("""SELECT n_nationkey, n_name, expected, actual, abs(actual - expected) * 100.0::DOUBLE / expected AS deviation FROM
(SELECT n_nationkey, n_name, 50 AS expected, count(c_custkey) AS actual FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2)""")
def coverage_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", F.lit(50).alias("expected"))
    members = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("n_nationkey"), "c_custkey")
    found = graph.coverage(groups, members, "n_nationkey", "c_custkey", "expected")
    return found.join(groups.select("n_nationkey", "n_name"), "n_nationkey")


@query(f"""WITH e AS (SELECT DISTINCT src_id, dst_id, src_id::VARCHAR || '>' || dst_id::VARCHAR AS edge FROM ({_EDGES_SQL})),
c AS (SELECT src_id AS id, 1 AS length, [edge] AS trail FROM e WHERE src_id = dst_id UNION ALL
SELECT a.src_id, 2, [a.edge, b.edge] FROM e a JOIN e b ON b.src_id = a.dst_id AND b.dst_id = a.src_id WHERE a.edge <> b.edge)
SELECT id, length, array_to_string(trail, ',') AS trail FROM c ORDER BY length, id, trail LIMIT 100""")
def chain_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cycles of up to 20 edges in the whole graph of chains, at most 100 of them, the shortest first. The
    SQL stops at two edges: these graphs are so dense that the first 100 are never longer."""
    return graph.cycles(_edges(spark, sf_dir), keep=cut).select(F.col("start").alias("id"), "length", F.array_join("trail", ",").alias("trail"))


_LAST_STEPS_SQL = f"""SELECT DISTINCT from_id AS src_id, to_id AS dst_id FROM (SELECT l_partkey AS from_id, lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY {_ORDER_SQL}) AS to_id, l_linenumber AS position FROM lineitem) WHERE to_id IS NOT NULL AND position >= 6"""


@query(f"""WITH RECURSIVE e AS MATERIALIZED ({_LAST_STEPS_SQL}), n AS (SELECT src_id AS id FROM e UNION SELECT dst_id FROM e),
r(s, t) AS (SELECT src_id, dst_id FROM e UNION SELECT r.s, e.dst_id FROM r JOIN e ON e.src_id = r.t),
c AS (SELECT a.s AS id, min(a.t) AS component FROM r a JOIN r b ON b.s = a.t AND b.t = a.s GROUP BY 1), k AS (SELECT n.id, least(n.id, coalesce(component, n.id)) AS component FROM n LEFT JOIN c USING (id))
SELECT id, component, count(*) OVER (PARTITION BY component) AS size FROM k""")
def strong_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that follow each other at the end of the longest chains: a sparse graph with large and small components, and without most."""
    steps = chains.pairs(table(spark, sf_dir, "lineitem"), "l_orderkey", ORDER, "l_partkey").where("position >= 6")
    return graph.strong_components(steps.select(F.col("from_id").alias("src_id"), F.col("to_id").alias("dst_id")), keep=stored)


@query("""WITH b AS (SELECT o_custkey AS id, o_orderkey AS ord, o_orderpriority AS priority, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS price FROM orders)
SELECT id, arg_max(priority, ord) AS priority, arg_max(price, ord) FILTER (price IS NOT NULL) AS price, max(ord) AS ord FROM b GROUP BY 1""")
def node_merge_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _batches(spark, sf_dir)
    return graph.merge_coalesce(old, new, ["id"], "ord")


@query("""WITH b AS (SELECT o_custkey AS id, o_orderkey AS ord, o_orderpriority AS priority, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS price FROM orders)
SELECT id, priority, price, ord FROM b QUALIFY row_number() OVER (PARTITION BY id ORDER BY ord DESC) = 1""")
def node_merge_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _batches(spark, sf_dir)
    return graph.merge_overwrite(old, new, ["id"], "ord")


def _batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("ord"), F.col("o_orderpriority").alias("priority"), F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("price"))
    return rows.where("ord % 2 = 0"), rows.where("ord % 2 = 1")


@query(f"""WITH RECURSIVE e AS ({_EDGES_SQL}), o AS (SELECT src_id, count(*) AS n FROM e GROUP BY 1), w AS (SELECT e.src_id, e.dst_id, o.n FROM e JOIN o USING (src_id)),
p(k, id, rank) AS (SELECT 0, s_suppkey, 1.0::DOUBLE FROM supplier UNION ALL
SELECT k, id, rank FROM (SELECT p.k + 1 AS k, s.s_suppkey AS id, 0.15 + 0.85 * coalesce((SELECT sum(q.rank / w.n) FROM p q JOIN w ON w.src_id = q.id WHERE w.dst_id = s.s_suppkey), 0) AS rank FROM supplier s JOIN p ON p.id = s.s_suppkey WHERE p.k < 5))
SELECT id, round(rank, 6) AS rank FROM p WHERE k = 5""")
def pagerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    return analytics.pagerank(nodes, _edges(spark, sf_dir), rounds=5, keep=cut).select("id", F.round("rank", 6).alias("rank"))


def _levels_sql(most: int = 6) -> str:
    """Shortest paths counted level by level; these graphs are so dense that no pair is as far apart as ``most``."""
    levels = ["l0 AS MATERIALIZED (SELECT s_suppkey AS s, s_suppkey AS t, 0 AS d, 1.0::DOUBLE AS n FROM supplier)"]
    for k in range(1, most + 1):
        seen = " UNION ALL ".join(f"SELECT s, t FROM l{j}" for j in range(k))
        levels.append(f"l{k} AS MATERIALIZED (SELECT l.s, g.dst_id AS t, {k} AS d, sum(l.n) AS n FROM l{k - 1} l JOIN g ON g.src_id = l.t WHERE NOT EXISTS (SELECT 1 FROM ({seen}) x WHERE x.s = l.s AND x.t = g.dst_id) GROUP BY 1, 2)")
    return ", ".join([*levels, "p AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT * FROM l{k}" for k in range(1, most + 1)) + ")"])


@query(f"""WITH g AS MATERIALIZED (SELECT DISTINCT src_id, dst_id FROM ({_EDGES_SQL}) WHERE src_id <> dst_id), {_levels_sql()},
b AS (SELECT a.t AS id, sum(a.n * z.n / c.n) AS betweenness FROM p a JOIN p z ON z.s = a.t JOIN p c ON c.s = a.s AND c.t = z.t AND c.d = a.d + z.d WHERE a.s <> z.t GROUP BY 1)
SELECT s_suppkey AS id, round(coalesce(betweenness, 0), 4) AS betweenness FROM supplier LEFT JOIN b ON id = s_suppkey""")
def betweenness(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    return analytics.betweenness(nodes, _edges(spark, sf_dir), keep=stored).select("id", F.round("betweenness", 4).alias("betweenness"))


@query()
def louvain(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    return analytics.communities(nodes, _edges(spark, sf_dir), keep=stored)


_EN = r"\b(?:Narrated|reported\s+by|on\s+the\s+authority\s+of|from|who\s+heard\s+from)\b"
#: White space as Unicode has it, at the ends of a text; and the rules of names.
_ENDS = r"^[\s\p{Z}\x1c-\x1f\x85]+|[\s\p{Z}\x1c-\x1f\x85]+$"


def _name_sql(raw: str) -> str:
    return rf"nullif(regexp_replace(regexp_replace({raw}, '{_ENDS}', '', 'g'), '[.,;:!?()]+$', ''), '')"


@query(rf"""SELECT doc_id, p - 1 AS position, name FROM (SELECT doc_id, generate_subscripts(parts, 1) AS p, unnest(parts) AS raw FROM (SELECT doc_id, regexp_split_to_array(text, '(?i){_EN}') AS parts FROM documents WHERE lang = 'en'))
, LATERAL (SELECT {_name_sql("raw")} AS name) WHERE name IS NOT NULL""")
def en_chain_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where("lang = 'en'")
    return docs.select("doc_id", F.explode(chains.spans(F.col("text"), "en")).alias("s")).select("doc_id", F.col("s.position").cast("long").alias("position"), "s.name")


_PLAIN_AR = r"trim(regexp_replace({}, '[\s\p{{Z}}\x1c-\x1f\x85]+', ' ', 'g'))"


@query(rf"""WITH d AS (SELECT doc_id, unnest([source, lang, text]) AS raw, unnest([0, 1, 2]) AS k, unnest(['haddathana', 'an', 'qala']) AS method FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL),
n AS (SELECT *, {_name_sql(_PLAIN_AR.format("raw"))} AS name FROM d)
SELECT doc_id, name, (row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1)::BIGINT AS position, method FROM n WHERE name IS NOT NULL""")
def ar_chain_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as the last name of a chain with three Arabic phrases."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("حدثنا "), "source", F.lit(" عن "), "lang", F.lit(" قال "), "text").alias("isnad"))
    found = rows.select("doc_id", F.explode(chains.spans(F.col("isnad"), "ar")).alias("s"))
    return found.select("doc_id", "s.name", F.col("s.position").cast("long").alias("position"), "s.method")


def _json_sql(**fields: str) -> str:
    """A JSON object of the SQL expressions that aren't null."""
    return "'{' || concat_ws(',', " + ", ".join(f"""'"{k}":' || to_json({v})::VARCHAR""" for k, v in fields.items()) + ") || '}'"


_FAN_SQL = rf"""WITH c AS (SELECT concat_ws(':', 'sunnah', role, conv_id, turn) AS sid, 'hdt:' || concat_ws(':', 'sunnah', role, conv_id, turn) AS hid, 'col:' || trim(regexp_replace(lower(role), '[^a-z0-9]+', '_', 'g'), '_') AS cid,
    role, conv_id::INTEGER AS book, turn::INTEGER AS number, text, CASE WHEN turn % 2 = 0 THEN 'sahih' END AS grade FROM conversations),
s AS (SELECT sid, hid, generate_subscripts(parts, 1) AS p, unnest(parts) AS raw FROM (SELECT sid, hid, regexp_split_to_array(text, '(?i){_EN}') AS parts FROM c WHERE text <> '')),
m AS (SELECT sid, hid, name, 'nar:' || substr(sha1('en:' || lower(trim(name, ' ')) || '|ar:'), 1, 24) AS nid, row_number() OVER (PARTITION BY sid ORDER BY p) - 1 AS k FROM (SELECT sid, hid, p, {_name_sql("raw")} AS name FROM s) WHERE name IS NOT NULL),
l AS (SELECT sid, list(nid ORDER BY k) AS members FROM m GROUP BY 1),
b AS (SELECT c.*, coalesce(members, []) AS members FROM c LEFT JOIN l USING (sid)),
nodes AS (
    SELECT sid, 0 AS k, 'Hadith' AS label, hid AS id, {_json_sql(matn_en="text", isnad_raw_en="text", grade="grade", grade_normalized="coalesce(grade, 'unknown')", source_corpus="'sunnah'", sect="'sunni'", collection_name="role")} AS props FROM b
    UNION ALL SELECT sid, 1, 'Collection', cid, {_json_sql(name_en="role", sect="'sunni'", source_corpus="'sunnah'")} FROM b
    UNION ALL SELECT sid, 2, 'Chain', 'chn:' || substr(sha1(array_to_string(list_prepend(hid, members), '|')), 1, 24), {_json_sql(hadith_id="hid", chain_index="0", chain_length="len(members)", is_complete="len(members) > 0", narrator_ids="members")} FROM b
    UNION ALL SELECT sid, 3, 'Grading', 'grd:' || hid, {_json_sql(hadith_id="hid", grade="grade", grade_normalized="grade", scholar_name="role")} FROM b WHERE grade IS NOT NULL
    UNION ALL SELECT sid, 4 + k, 'Narrator', nid, {_json_sql(name_en="name")} FROM m),
first AS (SELECT label, id, props FROM nodes QUALIFY row_number() OVER (PARTITION BY label, id ORDER BY sid, k, props) = 1)"""


@query(f"{_FAN_SQL} SELECT * FROM first")
def fan_out_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.fan_out(_staged(spark, sf_dir))[0]


@query(f"""{_FAN_SQL} SELECT 'APPEARS_IN' AS label, hid AS src_id, 'Hadith' AS src_label, cid AS dst_id, 'Collection' AS dst_label, {_json_sql(book_number="book", hadith_number_in_book="number")} AS props FROM b
UNION ALL SELECT 'NARRATED', members[1], 'Narrator', hid, 'Hadith', '{{}}' FROM b WHERE len(members) > 0
UNION ALL SELECT 'GRADED_BY', hid, 'Hadith', 'grd:' || hid, 'Grading', '{{}}' FROM b WHERE grade IS NOT NULL
UNION ALL SELECT 'TRANSMITTED_TO', nid, 'Narrator', next, 'Narrator', {_json_sql(position_in_chain="k", hadith_id="hid")} FROM (SELECT *, lead(nid) OVER (PARTITION BY sid ORDER BY k) AS next FROM m) WHERE next IS NOT NULL""")
def fan_out_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.fan_out(_staged(spark, sf_dir))[1]


@query(f"""{_FAN_SQL}, links AS (SELECT sid, -1 AS k, 'APPEARS_IN' AS label, hid AS src, cid AS dst, {_json_sql(book_number="book", hadith_number_in_book="number")} AS props FROM b
    UNION ALL SELECT sid, -1, 'NARRATED', members[1], hid, '{{}}' FROM b WHERE len(members) > 0 UNION ALL SELECT sid, -1, 'GRADED_BY', hid, 'grd:' || hid, '{{}}' FROM b WHERE grade IS NOT NULL
    UNION ALL SELECT sid, k, 'TRANSMITTED_TO', nid, next, {_json_sql(position_in_chain="k", hadith_id="hid")} FROM (SELECT *, lead(nid) OVER (PARTITION BY sid ORDER BY k) AS next FROM m) WHERE next IS NOT NULL),
last AS (SELECT label, src || '>' || dst AS id, props FROM links QUALIFY row_number() OVER (PARTITION BY label, src, dst ORDER BY sid DESC, k DESC) = 1),
every AS (SELECT 'node' AS kind, * FROM first UNION ALL SELECT 'edge', * FROM last)
SELECT kind, label, id, name, json_extract_string(props, '$."' || coalesce(nullif(name, ''), 'none') || '"') AS value FROM (SELECT *, unnest(CASE WHEN props = '{{}}' THEN [''] ELSE json_keys(props) END) AS name FROM every)""")
def stream_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain of four streaming queries over one batch of all conversations in several files, from its message to the graph: each
    property of each node and edge, of edges that come again the last one's; a row without a name for those that have none."""
    from ..streaming import stages

    layout = stages.Layout(folder(spark, "stream"))
    _staged(spark, sf_dir).repartitionByRange(5, "source_id").sortWithinPartitions("source_id").write.parquet(f"{layout.root}/raw/b1")
    stages.publish(spark, layout, stages.TOPICS[0], "b1", "sunnah", f"{layout.root}/raw/b1", 1)
    work = {"dedup": stages.dedup(), "enrich": stages.enrich(), "normalize": stages.normalize(), "ingest": stages.ingest(layout)}
    for name in stages.STAGES:
        stages.start(spark, layout, name, work[name]).awaitTermination()
    nodes, edges = stages.current_graph(spark, layout)
    both = nodes.select(F.lit("node").alias("kind"), "label", "id", "props").union(edges.select(F.lit("edge"), "label", F.concat("src_id", F.lit(">"), "dst_id"), "props"))
    found = both.select("kind", "label", "id", F.explode_outer(F.from_json("props", "map<string,string>")).alias("name", "value"))
    return found.withColumn("name", F.coalesce("name", F.lit("")))


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(
        F.concat_ws(":", F.lit("sunnah"), "role", "conv_id", "turn").alias("source_id"), F.lit("sunnah").alias("source_corpus"), F.col("role").alias("collection_name"),
        F.col("conv_id").cast("int").alias("book_number"), F.col("turn").cast("int").alias("hadith_number"), F.col("text").alias("matn_en"), F.col("text").alias("isnad_raw_en"),
        F.when(F.col("turn") % 2 == 0, "sahih").alias("grade"), F.lit("sunni").alias("sect"),
    )
    return schemas.conform(rows, "hadiths")


@query(f"""WITH c AS (SELECT concat_ws(':', 'sunnah', role, conv_id, turn) AS sid, * FROM conversations), m AS (SELECT count(*) AS n, count(*) - count(DISTINCT sid) AS d, count(*) FILTER (trim(coalesce(text, ''), E' \\t\\n\\r') = '') AS e FROM c),
r AS (SELECT unnest([{{'c': 'row_count', 's': CASE WHEN n > 0 THEN 'PASS' ELSE 'FAIL' END, 'v': n::DOUBLE}}, {{'c': 'schema_conformance', 's': 'PASS', 'v': 0}},
    {", ".join(f"{{'c': 'null_check_{c}', 's': 'PASS', 'v': 0}}" for c in ("source_id", "source_corpus", "collection_name", "sect"))},
    {{'c': 'duplicate_ids', 's': CASE WHEN d = 0 THEN 'PASS' ELSE 'WARN' END, 'v': d}}, {{'c': 'empty_matn_ar', 's': 'WARN', 'v': n}}, {{'c': 'empty_matn_en', 's': CASE WHEN e * 100.0 / n < 50 THEN 'PASS' ELSE 'WARN' END, 'v': e}},
    {{'c': 'book_coverage', 's': 'PASS', 'v': 100}}, {{'c': 'chapter_coverage', 's': 'PASS', 'v': 0}}, {{'c': 'drift_row_count', 's': CASE WHEN abs(n - 400) <= 120 THEN 'PASS' ELSE 'DRIFT' END, 'v': round(abs(n - 400) * 100.0::DOUBLE / 400, 2)}}]) AS r FROM m)
SELECT r.c AS "check", r.s AS status, r.v::DOUBLE AS value FROM r""")
def validation_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks of staged conversations, by one aggregation, with the number of rows against a baseline of 400."""
    return validation.validate(_staged(spark, sf_dir), "hadiths", {"row_count": 400})


_LOADED_SQL = f"""WITH c AS (SELECT 'hdt:' || concat_ws(':', 'sunnah', role, conv_id, turn) AS hid, 'grd:' || concat_ws(':', 'sunnah', role, conv_id, turn) AS gid, 'col:sunnah:' || role AS cid, role, conv_id::INTEGER AS book, turn::INTEGER AS number, text, CASE WHEN turn % 2 = 0 THEN 'sahih' END AS grade FROM conversations),
every AS (SELECT 'Hadith' AS label, hid AS id, {_json_sql(matn_en="text", isnad_raw_en="text", grade="grade", grade_normalized="coalesce(grade, 'unknown')", source_corpus="'sunnah'", sect="'sunni'", collection_name="role")} AS props FROM c
UNION ALL SELECT 'Grading', gid, {_json_sql(hadith_id="hid", grade="grade", grade_normalized="grade", scholar_name="role")} FROM c WHERE grade IS NOT NULL
UNION ALL SELECT 'Collection', cid, {_json_sql(name_en="any_value(role)", sect="'sunni'", total_hadiths="count(*)::INTEGER", source_corpus="'sunnah'")} FROM c GROUP BY cid
UNION ALL SELECT 'APPEARS_IN', hid || '>' || cid, {_json_sql(book_number="book", hadith_number_in_book="number")} FROM c UNION ALL SELECT 'GRADED_BY', hid || '>' || gid, '{{}}' FROM c WHERE grade IS NOT NULL)
SELECT label, id, name, json_extract_string(props, '$."' || coalesce(nullif(name, ''), 'none') || '"') AS value FROM (SELECT *, unnest(CASE WHEN props = '{{}}' THEN [''] ELSE json_keys(props) END) AS name FROM every)"""


@query(_LOADED_SQL)
def load_nodes_and_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each property of the nodes and edges that the loaders make of staged conversations and their collections; a row without a
    name for those that have none."""
    staged = _staged(spark, sf_dir)
    nodes = graph.hadiths(staged).union(graph.gradings(staged)).union(graph.collections(parsers.collections(staged)))
    edges = graph.appears_in(staged).union(graph.graded_by(staged)).select("label", F.concat("src_id", F.lit(">"), "dst_id").alias("id"), "props")
    found = nodes.union(edges).select("label", "id", F.explode_outer(F.from_json("props", "map<string,string>")).alias("name", "value"))
    return found.withColumn("name", F.coalesce("name", F.lit("")))


# ---- parsers: files written from the tables, then parsed ----


def _csv(rows: DataFrame, path: str) -> str:
    rows.write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    return path


_LK_BOOKS = "CASE turn % 3 WHEN 0 THEN 'bukhari' WHEN 1 THEN 'abu_dawud' END"


@query(rf"""SELECT 'lk:' || book || ':' || conv_id || ':' || turn AS source_id, book AS collection_name, md5(coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(t, '<[^>]+>', '', 'g'), '&[a-zA-Z]+;|&#[0-9]+;', '', 'g'), '{_ENDS}', '', 'g'), ''), '')) AS matn_digest, role AS grade
FROM (SELECT *, {_LK_BOOKS} AS book, '<b>' || regexp_replace(text, '[\n\r"\\]', ' ', 'g') || '</b>&nbsp;' AS t FROM conversations) WHERE book IS NOT NULL""")
def parse_lk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first source's layout of a folder for each book; a third folder is unknown and left out."""
    root, rows = folder(spark, "lk"), table(spark, sf_dir, "conversations")
    values = {"Chapter_Number": F.col("conv_id"), "Hadith_number": F.col("turn"), "English_Matn": F.concat(F.lit("<b>"), F.regexp_replace("text", r'[\n\r"\\]', " "), F.lit("</b>&nbsp;")), "English_Grade": F.col("role")}
    columns = [values.get(c, F.lit(None)).cast("string").alias(c) for c in parsers.LK_COLUMNS]
    for k, name in enumerate(("bukhari", "abudaud", "other")):
        _csv(rows.where(F.col("turn") % 3 == k).select(*columns), f"{root}/{name}")
    hadiths, _, _ = parsers.lk(spark, root)
    return hadiths.select("source_id", "collection_name", F.md5(F.coalesce("matn_en", F.lit(""))).alias("matn_digest"), "grade")


@query("""SELECT 'x:S' || s_suppkey AS bio_id, s_name AS name_ar, lower(s_name) AS name_en, (s_suppkey % 300)::INTEGER AS death_year_ah, CASE WHEN s_suppkey % 2 = 0 THEN 'thiqa' END AS trustworthiness, 'x' AS source FROM supplier""")
def parse_bios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Biographies under other names of the columns, each twice; the first stays."""
    k = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(F.concat(F.lit("S"), k).alias("Narrator_ID"), F.col("s_name").alias("Narrator"), F.lower("s_name").alias("English_Name"), (k % 300).alias("Death"), F.when(k % 2 == 0, "thiqa").alias("Jarh_Tadil"))
    twice = rows.unionByName(rows.withColumn("Death", F.lit(7).cast("long"))).coalesce(1)
    found = parsers.bios(spark, _csv(twice, f"{folder(spark, 'bios')}/b"), "x")
    return found.select("bio_id", "name_ar", "name_en", "death_year_ah", "trustworthiness", "source")


@query("""SELECT source_id, matn_ar, isnad_raw_ar, grade FROM (SELECT 'sanadset:sanadset:' || c_nationkey || ':' || c_custkey || ':' || (row_number() OVER (ORDER BY c_custkey) - 1) AS source_id, c_name AS matn_ar,
CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment || ' عن ' || c_nationkey END AS isnad_raw_ar, CASE WHEN c_custkey % 5 > 0 THEN 'sahih' END AS grade FROM customer)""")
def parse_sanadset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged texts; every third has only the note that it has no chain."""
    k = F.col("c_custkey")
    sanad = F.when(k % 3 == 0, F.lit("No SANAD")).otherwise(F.concat(F.lit("<NAR>"), "c_mktsegment", F.lit("</NAR> عن <NAR>"), "c_nationkey", F.lit("</NAR>")))
    text_ = F.concat(F.lit("<SANAD>"), sanad, F.lit("</SANAD><MATN>"), "c_name", F.lit("</MATN>"))
    rows = table(spark, sf_dir, "customer").select(k.alias("hadith_id"), F.col("c_nationkey").alias("book_id"), text_.alias("hadith"), F.when(k % 5 > 0, "sahih").otherwise("nan").alias("grade"))
    hadiths, _ = parsers.sanadset(spark, _csv(rows.coalesce(1).sortWithinPartitions("hadith_id"), f"{folder(spark, 'sanadset')}/s"))
    return hadiths.select("source_id", "matn_ar", "isnad_raw_ar", "grade")


def _named(spark: SparkSession, files: DataFrame, where: str, end: str) -> str:
    """Writes each row (name, value) as a file of that name with the given ending, into a new folder."""
    root = folder(spark, where)
    files.write.partitionBy("name").text(f"{root}-parts")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for part in system.globStatus(path(f"{root}-parts/name=*/part-*")):
        name = part.getPath().getParent().getName().removeprefix("name=")
        system.rename(part.getPath(), path(f"{root}/{name}{end}"))
    system.deleteOnExit(path(f"{root}-parts"))
    return root


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as items of files of two hundred: k, the file's number b, and texts."""
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.expr("c_custkey div 200").cast("string").alias("b"), "c_name", "c_mktsegment", "c_nationkey")


def _list(item: Column) -> Column:
    return F.to_json(F.array_sort(F.collect_list(item)))


@query("""SELECT 'thaqalayn:' || CASE WHEN b % 2 = 0 THEN 'the_book_' || b ELSE 'other' END || ':' || b || ':' || k AS source_id, c_name AS matn_en, c_mktsegment AS matn_ar, CASE WHEN k % 3 > 0 THEN 'sahih' END AS grade, c_nationkey::INTEGER AS chapter_number, 'shia' AS sect
FROM (SELECT *, c_custkey AS k, c_custkey // 200 AS b FROM customer)""")
def parse_thaqalayn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Books in files of both shapes, wrapped with a name and plain lists, with each field under either of its names."""
    rows, k = _customers(spark, sf_dir), F.col("k")
    odd, own = k % 2 == 1, F.lit(None).cast("string")
    item = F.struct(
        F.when(odd, k).alias("hadithNumber"), F.when(~odd, k).alias("id"), F.when(odd, F.col("c_name")).alias("textEn"), F.when(~odd, F.col("c_name")).alias("englishText"), F.when(odd, F.col("c_mktsegment")).alias("textAr"),
        F.when(~odd, F.col("c_mktsegment")).alias("arabicText"), F.when(odd & (k % 3 > 0), "sahih").alias("grade"), F.when(~odd & (k % 3 > 0), "sahih").alias("majlisiGrading"), F.col("c_nationkey").alias("chapterNumber"), F.lit("Other").alias("book"), own.alias("bookName"),
    )
    files = rows.groupBy("b").agg(_list(item).alias("items"))
    value = F.when(F.col("b").cast("int") % 2 == 0, F.concat(F.lit('{"bookName": "The Book, '), "b", F.lit('", "data": '), "items", F.lit("}"))).otherwise(F.col("items"))
    root = _named(spark, files.select(F.concat(F.lit("book_"), "b").alias("name"), value.alias("value")), "thaqalayn", ".json")
    return parsers.thaqalayn(spark, f"{root}/*.json").select("source_id", "matn_en", "matn_ar", "grade", "chapter_number", "sect")


@query("""SELECT 'fawaz:c' || (c_custkey // 200) || ':' || c_custkey AS source_id, CASE WHEN c_custkey % 3 <> 0 THEN c_name END AS matn_en, CASE WHEN c_custkey % 3 <> 1 THEN c_mktsegment END AS matn_ar,
CASE WHEN (c_custkey // 200) % 2 = 0 THEN 'shia' ELSE 'sunni' END AS sect FROM customer""")
def parse_fawaz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English and Arabic editions: a third of the numbers in one of them only; the sect is in the edition's name."""
    k = F.col("k")
    both = []
    for lang, value, there in (("eng", "c_name", k % 3 != 0), ("ara", "c_mktsegment", k % 3 != 1)):
        item = F.struct(k.alias("hadithnumber"), F.col(value).alias("text"), F.array().cast("array<struct<name:string,grade:string>>").alias("grades"))
        name = F.when(F.col("b").cast("int") % 2 == 0, F.concat(F.lit("Al-Kafi "), "b")).otherwise(F.concat(F.lit("Sahih "), "b"))
        files = _customers(spark, sf_dir).where(there).groupBy("b").agg(F.array_sort(F.collect_list(item)).alias("hadiths"))
        both.append(files.select(F.concat(F.lit(f"{lang}-c"), "b").alias("name"), F.to_json(F.struct(F.struct(name.alias("name")).alias("metadata"), "hadiths")).alias("value")))
    root = _named(spark, both[0].union(both[1]), "fawaz", ".json")
    return parsers.fawaz(spark, root).select("source_id", "matn_en", "matn_ar", "sect")


@query("""SELECT 'sunnah:c' || (c_custkey // 200) || ':' || c_nationkey || ':' || c_custkey AS source_id, c_name AS matn_en, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS matn_ar,
CASE c_custkey % 3 WHEN 1 THEN 'sahih' WHEN 2 THEN '["sahih","hasan"]' END AS grade FROM customer""")
def parse_sunnah_api(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of an API: bodies in both languages or one plain body, no grade, one, or a list."""
    k = F.col("k")
    body = lambda lang, value: F.struct(F.lit(lang).alias("lang"), F.col(value).alias("body"))
    grade = lambda *g: F.array(*(F.struct(F.lit(x).alias("grade")) for x in g))
    grades = F.when(k % 3 == 1, grade("sahih")).when(k % 3 == 2, grade("sahih", "hasan"))
    item = F.struct(k.cast("string").alias("hadithNumber"), F.col("c_nationkey").cast("string").alias("bookNumber"), F.when(k % 2 == 0, F.array(body("en", "c_name"), body("ar", "c_mktsegment"))).alias("hadith"), F.when(k % 2 == 1, F.col("c_name")).alias("body"), grades.alias("grades"))
    files = _customers(spark, sf_dir).groupBy("b").agg(_list(item).alias("value"))
    root = _named(spark, files.select(F.concat(F.lit("c"), "b", F.lit("_hadiths")).alias("name"), "value"), "api", ".json")
    return parsers.sunnah_api(spark, root).select("source_id", "matn_en", "matn_ar", "grade")


@query("""SELECT 'sunnah:c' || (c_custkey // 200) || ':' || c_nationkey || ':0:' || c_custkey AS source_id, c_name AS matn_en, CASE WHEN c_custkey % 2 = 0 THEN 'sahih' ELSE '["sahih","hasan"]' END AS grade, c_mktsegment AS chapter_name_en FROM customer""")
def parse_sunnah_scraped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scraped lists beside their manifest; grades in one string."""
    k = F.col("k")
    item = F.struct(k.cast("string").alias("hadith_number"), F.col("c_nationkey").cast("string").alias("book_number"), F.col("c_name").alias("text_en"), F.when(k % 2 == 0, "sahih").otherwise("sahih; hasan").alias("grade"), F.col("c_mktsegment").alias("chapter_name_en"))
    files = _customers(spark, sf_dir).groupBy("b").agg(_list(item).alias("value")).select(F.concat(F.lit("c"), "b").alias("name"), "value")
    manifest = files.groupBy().agg(F.lit("manifest").alias("name"), F.to_json(F.collect_list(F.struct(F.col("name").alias("hadith_number")))).alias("value"))
    root = _named(spark, files.union(manifest), "scraped", ".json")
    return parsers.sunnah_scraped(spark, root).select("source_id", "matn_en", "grade", "chapter_name_en")


@query("""SELECT 'open_hadith:c' || (c_custkey // 200) || ':' || CASE WHEN c_custkey % 4 > 0 THEN c_custkey ELSE row_number() OVER (PARTITION BY c_custkey // 200 ORDER BY c_custkey) END AS source_id, c_name AS matn_ar, 'sunni' AS sect FROM customer""")
def parse_open_hadith(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files without a header and with a suffix for vocalised texts; every fourth number is missing, so it is the row's place."""
    line = F.concat(F.when(F.col("k") % 4 > 0, F.col("k").cast("string")).otherwise(F.lit("")), F.lit(',"'), "c_name", F.lit('"'))
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", line.alias("line")))), lambda x: x["line"]), "\n")
    files = _customers(spark, sf_dir).groupBy("b").agg(lines.alias("value")).select(F.concat(F.lit("c"), "b", F.lit("-tashkeel")).alias("name"), "value")
    return parsers.open_hadith(spark, _named(spark, files, "open", ".csv")).select("source_id", "matn_ar", "sect")


@query(f"""WITH p AS ({_PAIRS_SQL}) SELECT l_orderkey::VARCHAR AS hadith_id, from_id::VARCHAR AS from_external_id, to_id::VARCHAR AS to_external_id, a.s_name AS from_narrator_name, b.s_name AS to_narrator_name
FROM p JOIN supplier a ON a.s_suppkey = from_id JOIN supplier b ON b.s_suppkey = to_id WHERE from_id <> to_id""")
def parse_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges between neighbours of comma-separated chains, one for each order."""
    ordered = chains.ordered_ids(table(spark, sf_dir, "lineitem"), "l_orderkey", ORDER, "l_suppkey")
    hadiths = ordered.select(F.col("l_orderkey").cast("string").alias("id"), F.array_join(F.col("member_ids").cast("array<string>"), ", ").alias("narrator_ids"))
    narrators = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return parsers.muhaddithat_edges(narrators, hadiths).select("hadith_id", "from_external_id", "to_external_id", "from_narrator_name", "to_narrator_name")


# ---- matching ----


@query("""WITH n AS (SELECT DISTINCT c_name AS name FROM customer), b AS (SELECT c_custkey AS cand, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS name_ar_normalized, lower(c_name) || ' ' AS name_en FROM customer)
SELECT name, cand, branch FROM (SELECT name, cand, 0 AS branch FROM n JOIN b ON name = name_ar_normalized UNION ALL SELECT name, cand, 1 FROM n JOIN b ON lower(name) = lower(trim(name_en)))""")
def exact_match_two_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer")
    bios = people.select(F.col("c_custkey").alias("cand"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("name_ar_normalized"), F.concat(F.lower("c_name"), F.lit(" ")).alias("name_en"))
    return matching.exact_matches(people.select(F.col("c_name").alias("name")).distinct(), bios).select("name", "cand", "branch")


@query("""WITH n AS (SELECT DISTINCT p_name AS a FROM part), b AS (SELECT DISTINCT p_name AS b FROM part)
SELECT a, b, levenshtein(a, b) AS distance FROM n JOIN b ON substr(a, 1, 2) = substr(b, 1, 2) WHERE abs(length(a) - length(b)) <= 2 AND levenshtein(a, b) <= 2""")
def fuzzy_block_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select("p_name").distinct()
    a, b = names.select(F.col("p_name").alias("a")), names.select(F.col("p_name").alias("b"))
    near = a.join(b, text.prefix_key(F.col("a")) == text.prefix_key(F.col("b"))).where(F.abs(F.length("a") - F.length("b")) <= 2)
    return near.where(similarity.within_distance(F.col("a"), F.col("b"))).select("a", "b", F.levenshtein("a", "b").cast("long").alias("distance"))


@query("""SELECT a.c_name AS name, count(*) AS near FROM customer a JOIN customer b ON a.c_name <> b.c_name AND levenshtein(a.c_name, b.c_name) <= 2 GROUP BY 1""")
def fuzzy_deletions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many other names are at most two edits from each customer's, of all pairs, without blocks."""
    names = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"))
    return matching.near_counts(names, "name")


def _part_bios(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    parts = table(spark, sf_dir, "part").groupBy("p_name").agg(F.min("p_partkey").alias("cand"))
    bios = parts.select("cand", F.col("p_name").alias("name_ar_normalized"), F.lit(None).cast("string").alias("name_en"), F.concat(F.lit("x"), "cand").alias("external_id"))
    return parts.select(F.concat(F.substring("p_name", 1, 3), F.lit("a"), F.substring("p_name", 4, 60)).alias("name")).distinct(), bios


#: Pairs of a block with their ratio: the longest common subsequence row by row, each row from whether letters agree.
_RATIO_SQL = """WITH parts AS (SELECT p_name AS b, min(p_partkey) AS cand FROM part GROUP BY 1), n AS (SELECT DISTINCT substr(b, 1, 3) || 'a' || substr(b, 4, 60) AS name FROM parts),
near AS (SELECT name, cand, b FROM n JOIN parts ON substr(name, 1, 2) = substr(b, 1, 2) WHERE b <> ''),
masks AS (SELECT *, [[CASE WHEN substr(name, k, 1) = substr(b, j, 1) THEN 1 ELSE 0 END FOR j IN range(1, length(b) + 1)] FOR k IN range(1, length(name) + 1)] AS m, [0 FOR j IN range(length(b))] AS zeros FROM near),
lcs AS (SELECT name, cand, b, list_last(list_reduce(list_prepend(zeros, m), lambda a, r: [list_max([CASE WHEN r[i] = 1 THEN coalesce(a[i - 1], 0) + 1 ELSE a[i] END FOR i IN range(1, j + 1)]) FOR j IN range(1, len(r) + 1)])) AS l FROM masks),
r AS (SELECT name, cand, b, 200.0::DOUBLE * l / (length(name) + length(b)) AS ratio FROM lcs)"""


@query(f"{_RATIO_SQL} SELECT name, cand, round_even(ratio / 100, 4) AS score FROM r WHERE abs(length(name) - length(b)) <= 2 AND levenshtein(name, b) <= 2 AND ratio >= 80")
def fuzzy_block_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.fuzzy_matches(*_part_bios(spark, sf_dir)).select("name", "cand", "score")


@query(f"{_RATIO_SQL} SELECT name, cand, round_even(ratio / 100, 4) AS score FROM r WHERE ratio >= 60")
def crossref_block_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.crossref_matches(*_part_bios(spark, sf_dir)).select("name", "cand", "score")


@query()
def disambiguate_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions: names of lineitems' nations, in chains of orders; biographies: nations."""
    s, n, l = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation"), table(spark, sf_dir, "lineitem")
    named = l.join(s, l["l_suppkey"] == s["s_suppkey"]).join(n, s["s_nationkey"] == n["n_nationkey"])
    order = F.row_number().over(Window.partitionBy("hadith_id").orderBy(*ORDER))  # the chains' own key: they are dealt out once
    name = F.when(F.col("l_linenumber") % 3 == 0, F.concat("n_name", F.lit("X"))).otherwise(F.col("n_name"))
    mentions = named.withColumn("hadith_id", F.col("l_orderkey").cast("string")).withColumn("k", order).select(
        F.concat_ws(":", "l_orderkey", "k").alias("mention_id"), "hadith_id", F.lit("lk").alias("source_corpus"), (F.col("k") - 1).alias("position_in_chain"),
        name.alias("name_raw"), name.alias("name_normalized"), (F.col("l_orderkey") * 1000 + F.col("k")).alias("ord"),
    )
    none = F.lit(None).cast("string")
    bios = n.select(
        F.col("n_nationkey").cast("long").alias("cand"), F.concat(F.lit("bio-"), "n_nationkey").alias("bio_id"), F.col("n_name").alias("name_ar"), F.lower("n_name").alias("name_en"), F.col("n_name").alias("name_ar_normalized"),
        F.lit(None).cast("int").alias("birth_year_ah"), (F.col("n_nationkey") * 20 + 40).alias("death_year_ah"), none.alias("generation"), none.alias("gender"), none.alias("trustworthiness"), none.alias("external_id"),
    )
    canonical, _, _ = matching.resolve(mentions, bios, keep=stored)
    return canonical.select("canonical_id", "name_ar", F.size("aliases").alias("n_aliases"), F.size("source_ids").alias("n_sources"), "mention_count")


@query("""WITH o AS (SELECT o_custkey, year(o_orderdate) - 1970 AS y, o_orderkey FROM orders), p AS (SELECT o_custkey, o_orderkey, y, lag(y) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS before FROM o)
SELECT o_custkey, o_orderkey, y::BIGINT AS y, before::BIGINT AS before FROM p WHERE abs(y - before) BETWEEN 2 AND 4""")
def temporal_gap_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", (F.year("o_orderdate") - 1970).cast("long").alias("y"))
    p = o.withColumn("before", F.lag("y").over(Window.partitionBy("o_custkey").orderBy("o_orderkey")))
    return p.where(similarity.plausible_gap(F.col("y"), F.col("before"), 2, 4))


@query("""WITH a AS (SELECT c_nationkey::VARCHAR AS k, c_custkey AS ord, c_mktsegment AS x, c_name AS bio FROM customer), r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ord) AS nth FROM a)
SELECT k AS canonical_id, count(*)::INTEGER AS mention_count, arg_min(bio, ord) AS name_ar, coalesce((SELECT string_agg(x, ',' ORDER BY o) FROM (SELECT x, min(ord) AS o FROM r q WHERE q.k = r.k AND nth > 1 GROUP BY x)), '') AS aliases, count(DISTINCT bio)::INTEGER AS n_sources FROM r GROUP BY k""")
def canonical_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("string")
    accepted = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").cast("string").alias("canonical_id"), F.col("c_custkey").alias("ord"), F.col("c_mktsegment").alias("mention_text"), F.lit("").alias("norm_name"), F.col("c_name").alias("bio_id"), F.col("c_name").alias("name_ar"),
        *(none.alias(c) for c in ("name_en", "generation", "gender", "trustworthiness", "external_id")), *(none.cast("int").alias(c) for c in ("birth_year_ah", "death_year_ah")),
    )
    found = matching.canonical_people(accepted)
    return found.select("canonical_id", "mention_count", "name_ar", F.array_join("aliases", ",").alias("aliases"), F.size("source_ids").alias("n_sources"))


# ---- vectors ----


_KNN_SQL = """WITH s AS (SELECT a.vec_id AS i, b.vec_id AS j, list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS score FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, j) AS k FROM s), t AS (SELECT least(i, j) AS a, greatest(i, j) AS b, max(score) AS score FROM r WHERE k <= 50 AND score >= 0.35 GROUP BY 1, 2)"""


@query(f"{_KNN_SQL} SELECT a, b, round(score, 4) AS score FROM t")
def parallel_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parallels.neighbours(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", threshold=0.35).select("a", "b", F.round("score", 4).alias("score"))


@query(f"""{_KNN_SQL} SELECT a AS hadith_id_a, b AS hadith_id_b, CASE WHEN score >= 0.45 THEN 'verbatim' WHEN score >= 0.40 THEN 'close_paraphrase' ELSE 'thematic' END AS variant_type, (a % 2) <> (b % 2) AS cross_sect FROM t""")
def pair_tiers_cross_sect(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    corpora = vectors.select(F.col("vec_id").alias("id"), F.when(F.col("vec_id") % 2 == 0, "sunnah").otherwise("thaqalayn").alias("source_corpus"))
    pairs = parallels.neighbours(vectors, "vec_id", "embedding", threshold=0.35)
    return parallels.links(pairs, corpora, 0.45, 0.40).select("hadith_id_a", "hadith_id_b", "variant_type", "cross_sect")


def _index(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, vector_index.Index]:
    """All vectors, and their index as read back from disk."""
    vectors, path = table(spark, sf_dir, "embeddings"), f"{folder(spark, 'vectors')}/index"
    vector_index.build(vectors, "vec_id", "embedding", path, stored)
    return vectors, vector_index.load(spark, path)


@query(f"{_KNN_SQL} SELECT a, b, round(score, 4) AS score FROM t")
def vector_index_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same links out of an index on disk, looked up in all cells that can hold one."""
    vectors, index = _index(spark, sf_dir)
    found = vector_index.search(index, vectors, "vec_id", "embedding", stored, threshold=0.35)
    return vector_index.pairs(found).select("a", "b", F.round("score", 4).alias("score"))


@query("""WITH s AS (SELECT a.vec_id AS id, b.vec_id AS partner, list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS score FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id AND a.vec_id % 100 = 0)
SELECT id, partner, round(score, 4) AS score, row_number() OVER (PARTITION BY id ORDER BY score DESC, partner)::INTEGER AS rank FROM s QUALIFY rank <= 10""")
def vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of all vectors for every vector whose id is divisible by 100."""
    vectors, index = _index(spark, sf_dir)
    found = vector_index.search(index, vectors.where("vec_id % 100 = 0"), "vec_id", "embedding", stored, k=10)
    return found.select("id", "partner", F.round("score", 4).alias("score"), "rank")


@query(r"""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS word FROM documents), c AS MATERIALIZED (SELECT doc_id, word, count(*) AS tf FROM w GROUP BY ALL),
d AS MATERIALIZED (SELECT word, 1 + ln((1.0::DOUBLE + (SELECT count(DISTINCT doc_id) FROM c)) / (1 + count(*))) AS idf, [('0x' || substr(md5(word), 4 * k + 1, 4))::INTEGER FOR k IN range(8)] AS chunks FROM c GROUP BY 1),
x AS (SELECT doc_id, h % 128 AS place, sum((1 + ln(tf)) * idf * CASE WHEN h >= 32768 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END) AS x FROM (SELECT doc_id, tf, idf, unnest(chunks) AS h FROM c JOIN d USING (word)) GROUP BY ALL),
m AS (SELECT doc_id, map_from_entries(list((place, x))) AS m, sqrt(sum(x * x)) AS length FROM x GROUP BY 1 HAVING sum(x * x) > 0),
v AS MATERIALIZED (SELECT doc_id AS id, [coalesce(m[p], 0) / length FOR p IN range(128)] AS v FROM m),
s AS (SELECT a.id AS i, b.id AS j, list_inner_product(a.v, b.v) AS score FROM v a JOIN v b ON a.id <> b.id),
r AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, j) AS k FROM s QUALIFY score >= 0.8), t AS (SELECT least(i, j) AS a, greatest(i, j) AS b, max(score) AS score FROM r WHERE k <= 50 GROUP BY 1, 2)
SELECT a AS hadith_id_a, b AS hadith_id_b, CASE WHEN score >= 0.9 THEN 'verbatim' WHEN score >= 0.8 THEN 'close_paraphrase' ELSE 'thematic' END AS variant_type FROM t""")
def embedded_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From texts to parallel links: vectors of all documents, then all pairs of them that are close paraphrases, by tier."""
    docs = table(spark, sf_dir, "documents")
    vectors = stored(embedding.embed(docs, "doc_id", "text", keep=stored))
    pairs = parallels.neighbours(vectors, "id", "v", threshold=0.8)
    corpora = docs.select(F.col("doc_id").alias("id"), F.col("source").alias("source_corpus"))
    return parallels.links(pairs, corpora).select("hadith_id_a", "hadith_id_b", "variant_type")


@query("""WITH s AS (SELECT a.vec_id AS i, b.vec_id AS j, list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS score FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id AND a.label = b.label)
SELECT i, j, k FROM (SELECT i, j, row_number() OVER (PARTITION BY i ORDER BY score DESC, j) AS k FROM s) WHERE k <= 3""")
def top3_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"), F.col("label").alias("of"))
    return partners.within(v, 3).select(F.col("id").alias("i"), F.col("partner").alias("j"), F.col("rank").alias("k"))


# ---- ranges ----


_LIVES_SQL = "SELECT o_custkey AS id, min(year(o_orderdate))::BIGINT AS birth_year, max(year(o_orderdate))::BIGINT AS death_year FROM orders GROUP BY 1"


@query(f"""WITH l AS ({_LIVES_SQL}), e AS (SELECT r_regionkey, 1992 + r_regionkey AS s, 1993 + r_regionkey AS t FROM region)
SELECT id, r_regionkey FROM l JOIN e ON death_year >= s AND birth_year <= t WHERE death_year - birth_year <= 5""")
def interval_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    people, events = _lives(spark, sf_dir)
    return analytics.overlaps(people, F.broadcast(events), max_life=5).select("id", "r_regionkey")


@query(f"""WITH l AS ({_LIVES_SQL}), e AS (SELECT r_regionkey, 1992 + r_regionkey AS s, 1993 + r_regionkey AS t FROM region)
SELECT id, r_regionkey FROM l JOIN e ON death_year >= s AND birth_year <= t""")
def interval_overlap_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    people, events = _lives(spark, sf_dir)
    return analytics.overlaps_bucketed(people, events, "birth_year", "death_year", "year_start", "year_end", width=2).select("id", "r_regionkey")


def _lives(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    year = F.year("o_orderdate").cast("long")
    people = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.min(year).alias("birth_year"), F.max(year).alias("death_year"))
    events = table(spark, sf_dir, "region").select("r_regionkey", (F.col("r_regionkey") + 1992).alias("year_start"), (F.col("r_regionkey") + 1993).alias("year_end"))
    return people, events


@query(f"""WITH l AS ({_LIVES_SQL}), e AS (SELECT r_regionkey, 1992 + r_regionkey AS s, 1993 + r_regionkey AS t FROM region), n AS (SELECT id, count(*) AS n FROM l JOIN e ON death_year >= s AND birth_year <= t GROUP BY 1)
SELECT count(*) AS entities, round(avg(n), 2) AS avg_events, max(n) AS max_events FROM n""")
def overlap_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    people, events = _lives(spark, sf_dir)
    return analytics.overlap_stats(analytics.overlaps(people, F.broadcast(events)), "id")


@query("SELECT o_orderkey, greatest(1, (o_orderkey % 400) - 30) AS birth_year, (o_orderkey % 400) + 30 AS death_year FROM orders")
def compiler_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 400).alias("compilation_year"))
    return analytics.compiler_lives(rows).select("o_orderkey", "birth_year", "death_year")


# ---- joins ----


@query("""WITH s AS (SELECT source, doc_id, max(lang) FILTER (doc_id % 2 = 0) AS chapter FROM documents WHERE source IS NOT NULL GROUP BY 1, 2)
SELECT 'fawaz:' || d.doc_id AS source_id, coalesce(CASE WHEN d.doc_id % 3 = 0 THEN d.lang END, s.chapter) AS chapter_name_en, CASE WHEN s.source IS NULL THEN NULL ELSE (d.doc_id % 7)::INTEGER END AS book_number FROM documents d LEFT JOIN s ON s.source = d.source AND s.doc_id = d.doc_id""")
def enrich_fill_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, k = table(spark, sf_dir, "documents"), F.col("doc_id")
    common = [F.col("source").alias("collection_name"), k.cast("int").alias("hadith_number")]
    editions = schemas.conform(docs.select(F.concat(F.lit("fawaz:"), k).alias("source_id"), *common, F.when(k % 3 == 0, F.col("lang")).alias("chapter_name_en")), "hadiths")
    one = docs.where("source IS NOT NULL").groupBy("source", "doc_id").agg(F.max(F.when(k % 2 == 0, F.col("lang"))).alias("lang"))
    scraped = schemas.conform(one.select(F.concat(F.lit("sunnah:"), k).alias("source_id"), *common, (k % 7).cast("int").alias("book_number"), F.col("lang").alias("chapter_name_en")), "hadiths")
    return parsers.enrich_metadata(editions, scraped).select("source_id", "chapter_name_en", "book_number")


@query("""WITH e AS (SELECT conv_id, turn AS number, text FROM conversations WHERE role = 'user'), a AS (SELECT conv_id, turn - 1 AS number, text, turn AS ord FROM conversations WHERE role = 'assistant'),
one AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY conv_id, number ORDER BY ord DESC) = 1)
SELECT e.conv_id, e.number, length(e.text) AS n_en, length(one.text) AS n_ar FROM e LEFT JOIN one ON one.conv_id = e.conv_id AND one.number = e.number
UNION ALL SELECT a.conv_id, a.number, NULL, length(a.text) FROM a WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.conv_id = a.conv_id AND e.number = a.number)""")
def edition_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").withColumn("grades", F.lit(None).cast("string"))
    english = rows.where("role = 'user'").select("conv_id", F.col("turn").alias("number"), "text", "grades", F.col("turn").alias("ord"))
    arabic = rows.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("number"), "text", "grades", F.col("turn").alias("ord"))
    found = parsers.merge_editions(english, arabic, ["conv_id", "number"], "ord")
    return found.select("conv_id", "number", F.length("text_en").cast("long").alias("n_en"), F.length("text_ar").cast("long").alias("n_ar"))


@query("SELECT c_custkey, coalesce(n_name, c_nationkey::VARCHAR) AS nation FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON n_nationkey = c_nationkey")
def lookup_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return table(spark, sf_dir, "customer").join(names, "c_nationkey", "left").select("c_custkey", F.coalesce("n_name", F.col("c_nationkey").cast("string")).alias("nation"))


@query("""WITH a AS (SELECT o_orderkey AS name, md5(o_orderstatus) AS md5 FROM orders WHERE o_orderkey % 10 < 8), b AS (SELECT o_orderkey AS name, md5(CASE WHEN o_orderkey % 7 = 0 THEN 'x' ELSE o_orderstatus END) AS md5 FROM orders WHERE o_orderkey % 10 > 1)
SELECT coalesce(a.name, b.name) AS name, CASE WHEN a.name IS NULL THEN 'added' WHEN b.name IS NULL THEN 'removed' WHEN a.md5 <> b.md5 THEN 'changed' ELSE 'unchanged' END AS status FROM a FULL JOIN b ON a.name = b.name""")
def manifest_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    before = orders.where("o_orderkey % 10 < 8").select(F.col("o_orderkey").alias("name"), F.md5("o_orderstatus").alias("md5"))
    after = orders.where("o_orderkey % 10 > 1").select(F.col("o_orderkey").alias("name"), F.md5(F.when(F.col("o_orderkey") % 7 == 0, "x").otherwise(F.col("o_orderstatus"))).alias("md5"))
    return analytics.manifest_diff(before, after)


# ---- quality ----


@query("""SELECT unnest(['value', 'props', 'user_id']) AS column_name, unnest([count_if(value > 150), count_if(user_id % 5 = 0), 0]) AS nulls,
unnest([round(count_if(value > 150) * 100.0::DOUBLE / count(*), 2), round(count_if(user_id % 5 = 0) * 100.0::DOUBLE / count(*), 2), 0.0::DOUBLE]) AS null_pct FROM events""")
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.when(F.col("value") <= 150, F.col("value")).alias("value"), F.when(F.col("user_id") % 5 != 0, F.col("props")).alias("props"), "user_id")
    return quality.null_profile(rows, ["value", "props", "user_id"])


@query("SELECT count(*) AS n_rows, count(*) - count(DISTINCT CASE WHEN l_linenumber > 1 THEN l_orderkey END) AS duplicates FROM lineitem")
def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.when(F.col("l_linenumber") > 1, F.col("l_orderkey")).alias("id"))
    return quality.duplicate_ids(rows, "id")


@query("""SELECT metric, current, baseline, abs(current - baseline) * 100.0::DOUBLE / baseline AS drift_pct, abs(current - baseline) * 100.0::DOUBLE / baseline <= 30 AS ok FROM
(SELECT event_type AS metric, count_if(user_id % 3 > 0) AS current, count(*) AS baseline FROM events GROUP BY 1)""")
def drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    count = lambda df: df.groupBy(F.col("event_type").alias("metric")).agg(F.count("*").alias("value"))
    return quality.drift(count(rows.where("user_id % 3 > 0")), count(rows))


@query("SELECT round(count_if(regexp_matches(text, '[à-ÿ]')) * 100.0::DOUBLE / count(text), 2) AS of_values, round(count_if(regexp_matches(text, '[à-ÿ]')) * 100.0::DOUBLE / count(*), 2) AS of_rows FROM documents")
def script_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.match_ratio(table(spark, sf_dir, "documents"), "text", "[à-ÿ]")


@query("SELECT count(*) AS n_rows, round(count_if(trim(props) = '' OR props IS NULL) * 100.0::DOUBLE / count(*), 2) AS empty_pct FROM events")
def empty_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.empty_ratio(table(spark, sf_dir, "events"), "props")


@query("SELECT round(count(quality) * 100.0::DOUBLE / count(*), 2) AS quality_pct, round(count(nullif(toxic, 0)) * 100.0::DOUBLE / count(*), 2) AS toxic_pct FROM documents LEFT JOIN labels USING (doc_id)")
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left").withColumn("toxic", F.nullif("toxic", F.lit(0)))
    return quality.coverage(joined, "quality", "toxic")


@query("SELECT DISTINCT event_type FROM events WHERE event_type NOT IN ('click', 'view')")
def invalid_enum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.invalid_values(table(spark, sf_dir, "events"), "event_type", ("click", "view"))


# ---- functions ----


@query(r"""SELECT doc_id, md5(trim(regexp_replace(replace(replace(replace(text, 'é', 'e'), 'ü', 'u'), 'ñ', 'n'), '\s+', ' ', 'g'))) AS digest FROM documents""")
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Arabic rules leave Latin letters alone, so translated letters stand in for normalised ones."""
    plain = text.normalize_arabic(F.translate("text", "éüñ", "eun"))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(plain).alias("digest"))


@query(r"""SELECT page_id, md5(nullif(trim(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '&[a-zA-Z]+;|&#[0-9]+;', '', 'g'), E' \n\t\r'), '')) AS digest FROM pages""")
def html_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.md5(text.strip_html(F.col("html"))).alias("digest"))


@query(r"""SELECT event_id, try_cast(trunc(try_cast(v AS DOUBLE)) AS INTEGER) AS n, CASE WHEN lower(trim(s)) IN ('', 'nan', 'none') THEN NULL ELSE trim(s) END AS s FROM
(SELECT event_id, CASE event_id % 4 WHEN 0 THEN ' 12.9 ' WHEN 1 THEN 'x1' WHEN 2 THEN '' ELSE event_id::VARCHAR END AS v, CASE event_id % 3 WHEN 0 THEN ' NaN ' WHEN 1 THEN ' a b ' ELSE event_type END AS s FROM events)""")
def safe_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    number = F.when(e % 4 == 0, " 12.9 ").when(e % 4 == 1, "x1").when(e % 4 == 2, "").otherwise(e.cast("string"))
    word = F.when(e % 3 == 0, " NaN ").when(e % 3 == 1, " a b ").otherwise(F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", casts.safe_int(number).alias("n"), casts.safe_str(word).alias("s"))


@query("""SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'sahih_li_ghayrihi' WHEN 1 THEN 'daif' WHEN 2 THEN 'sahih' WHEN 3 THEN 'hasan' WHEN 4 THEN 'mawdu' ELSE 'unknown' END AS grade FROM events""")
def grade_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id") % 6
    raw = F.when(e == 0, "Sahih li-ghayrihi").when(e == 1, "ضعيف").when(e == 2, "Sahih (Authentic)").when(e == 3, "حسن").when(e == 4, "Fabricated").when(e == 5, "")
    return table(spark, sf_dir, "events").select("event_id", text.normalize_grade(raw).alias("grade"))


@query("""SELECT doc_id, 'sunnah:' || source || ':' || doc_id || ':0' AS source_id, 'hdt:sunnah:' || source || ':' || doc_id || ':0' AS hadith_id, 'grd:sunnah:' || source AS grading_id, substr(sha1(source), 1, 24) AS digest, 'col:' || trim(regexp_replace(lower(source), '[^a-z0-9]+', '_', 'g'), '_') AS collection_id FROM documents""")
def id_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = ids.source_id("sunnah", F.col("source"), F.col("doc_id"), F.lit(None))
    doubled = F.concat(F.lit("hdt:sunnah:sunnah:"), F.regexp_replace(built, "^sunnah:", ""))
    return table(spark, sf_dir, "documents").select(
        "doc_id", built.alias("source_id"), ids.hadith_id(doubled).alias("hadith_id"), ids.grading_id(F.concat(F.lit("hdt:sunnah:"), "source")).alias("grading_id"),
        ids.sha1_24(F.col("source")).alias("digest"), ids.stream_collection_id(F.col("source")).alias("collection_id"),
    )


@query("""SELECT s_suppkey, 'nar:' || substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab89ab89ab89ab', instr('0123456789abcdef', substr(h, 17, 1)), 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS canonical_id
FROM (SELECT s_suppkey, sha1(unhex('a1b2c3d4e5f67890abcdef1234567890') || encode(s_name)) AS h FROM supplier)""")
def uuid5_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_suppkey", ids.canonical_id(F.col("s_name")).alias("canonical_id"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'unknown corpus' WHEN 2 THEN 'no collection segment' ELSE 'empty segment,doubled corpus' END AS problems FROM events""")
def id_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id") % 4
    value = F.when(e == 0, "lk:bukhari:1").when(e == 1, "other:bukhari").when(e == 2, "lk").otherwise("lk:lk::1")
    return table(spark, sf_dir, "events").select("event_id", F.array_join(ids.source_id_problems(value), ",").alias("problems"))


# ---- reports, sets, top-k ----


@query("SELECT event_type AS stage, sum(greatest(0, (event_id % 100) - coalesce(CASE WHEN user_id % 4 > 0 THEN user_id % 90 END, 0)))::BIGINT AS lag FROM events GROUP BY ROLLUP (event_type)")
def lag_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    ends = rows.select(F.col("event_type").alias("stage"), F.col("event_id").alias("partition"), (F.col("event_id") % 100).alias("offset"))
    done = rows.select(F.col("event_type").alias("stage"), F.col("event_id").alias("partition"), F.when(F.col("user_id") % 4 > 0, F.col("user_id") % 90).otherwise(-1).alias("offset"))
    return analytics.lag(ends, done)


@query("SELECT regexp_extract(url, '//([^/]+)/', 1) AS prefix, count(*) AS objects, sum(length(html))::BIGINT AS bytes FROM pages GROUP BY ROLLUP (prefix)")
def storage_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("url", F.length("html").cast("long").alias("bytes"))
    return analytics.storage(pages, F.regexp_extract("url", "//([^/]+)/", 1))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(5)


@query("SELECT event_id, ts FROM events ORDER BY ts DESC, event_id LIMIT 100")
def latest_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "ts").orderBy(F.col("ts").desc(), "event_id").limit(100)


@query("SELECT DISTINCT c_nationkey AS k, 'both' AS side FROM customer WHERE c_nationkey IN (SELECT s_nationkey FROM supplier) UNION ALL (SELECT c_nationkey, 'left' FROM customer EXCEPT SELECT s_nationkey, 'left' FROM supplier)")
def key_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, s = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")), table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"))
    return c.intersect(s).withColumn("side", F.lit("both")).union(c.subtract(s).withColumn("side", F.lit("left")))


@query("SELECT conv_id, turn, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn)::BIGINT AS chapter FROM conversations")
def running_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    within = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.sum(F.when(F.col("role") == "user", 1).otherwise(0)).over(within).alias("chapter"))


_LEXICON = {"ritual/worship": ("the", "der"), "medicine": ("and", "und"), "end_times": ("of", "von")}


def _count_sql(words: tuple[str, ...]) -> str:
    return rf"len(regexp_extract_all(lower(text), '\b(?:{'|'.join(words)})\b'))"


@query(f"""WITH c AS (SELECT doc_id, [{", ".join(f"{{'n': {_count_sql(w)}, 'k': {k}, 't': '{t}'}}" for k, (t, w) in enumerate(_LEXICON.items()))}] AS s FROM documents WHERE length(text) >= 20),
r AS (SELECT doc_id, list_sort(list_transform(s, lambda x: {{'neg': -x.n, 'k': x.k, 't': x.t}})) AS s FROM c) SELECT doc_id, s[1].t AS topic_1, s[2].t AS topic_2, s[3].t AS topic_3 FROM r""")
def topic_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = analytics.topics_lexical(table(spark, sf_dir, "documents"), "doc_id", "text", _LEXICON)
    return found.select("doc_id", "topic_1", "topic_2", "topic_3")


# ---- messages ----


_MESSAGE_SQL = """SELECT event_id, user_id::VARCHAR AS batch_id, event_type, CASE WHEN event_id % 10 = 3 THEN 'unknown keys: extra' WHEN event_id % 10 = 7 THEN 'record_count is not a number of records' END AS error FROM events"""


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    record = F.when(F.col("event_id") % 10 == 7, -1).otherwise(F.col("event_id").cast("int"))
    fields = [F.col("user_id").cast("string").alias("batch_id"), F.col("event_type").alias("source"), F.col("event_id").cast("string").alias("b2_path"), F.col("ts").alias("timestamp"), record.alias("record_count")]
    return e.select(F.when(F.col("event_id") % 10 == 3, F.to_json(F.struct(*fields, F.lit(1).alias("extra")))).otherwise(F.to_json(F.struct(*fields))).alias("value"))


@query(f"WITH m AS ({_MESSAGE_SQL}) SELECT error, count(*) AS n FROM m WHERE error IS NOT NULL GROUP BY 1")
def stream_dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..streaming import messages

    return messages.split(messages.parse(_messages(spark, sf_dir)))[1].groupBy("error").agg(F.count("*").alias("n"))


@query(f"WITH m AS ({_MESSAGE_SQL}) SELECT batch_id, min(event_id)::VARCHAR AS first FROM m WHERE error IS NULL AND batch_id::BIGINT % 2 = 0 GROUP BY 1")
def stream_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..streaming import messages

    good, _ = messages.split(messages.parse(_messages(spark, sf_dir)))
    seen = table(spark, sf_dir, "events").where("user_id % 2 = 1").select(F.col("user_id").cast("string").alias("batch_id")).distinct()
    fresh = good.join(seen, "batch_id", "left_anti")
    return fresh.groupBy("batch_id").agg(F.min(F.col("b2_path").cast("long")).cast("string").alias("first"))


@query("""WITH RECURSIVE e AS MATERIALIZED (SELECT user_id, ts, min(event_id) AS event_id FROM events GROUP BY 1, 2),
f(user_id, ts) AS (SELECT user_id, min(ts) FROM e GROUP BY 1 UNION ALL SELECT f.user_id, min(e.ts) FROM f JOIN e ON e.user_id = f.user_id AND e.ts >= f.ts + INTERVAL 2 DAY GROUP BY f.user_id)
SELECT f.user_id, f.ts, event_id FROM f JOIN e USING (user_id, ts)""")
def stream_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's first event, then the first at least two days after the one before it: keyed state with expiry over a
    stream of all events, in two runs of the query, the second of which goes on from the first one's checkpoint."""
    from datetime import timedelta

    from ..streaming import once

    events, root = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id"), folder(spark, "once")
    middle = events.agg(F.expr("timestamp_micros(avg(unix_micros(ts))::bigint)").alias("m")).first()["m"]
    for part in (F.col("ts") < F.lit(middle), F.col("ts") >= F.lit(middle)):
        events.where(part).write.mode("append").parquet(f"{root}/in")
        found = once.once(spark.readStream.schema(events.schema).parquet(f"{root}/in"), "user_id", "ts", timedelta(days=2), order=("event_id",))
        once.start(found, lambda df, n: df.write.mode("overwrite").parquet(f"{root}/out/batch={n}"), f"{root}/progress").awaitTermination()
    return spark.read.schema(events.schema).parquet(f"{root}/out").select("user_id", F.col("ts").cast(dict(table(spark, sf_dir, "events").dtypes)["ts"]).alias("ts"), "event_id")


@query("""SELECT event_type AS stage, count(*) AS n FROM events WHERE NOT (ts < (SELECT max(ts) - INTERVAL 14 DAY FROM events) AND event_type IN (SELECT event_type FROM events GROUP BY 1 HAVING count(*) > 1000)) GROUP BY 1""")
def checkpoint_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..streaming import stages

    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("stage"), F.col("event_id").cast("string").alias("batch_id"), F.col("ts").alias("marked_at"))
    now = rows.agg(F.max("marked_at")).first()[0]
    return stages.sweep(rows, now, threshold=1000, days=14).groupBy("stage").agg(F.count("*").alias("n"))
