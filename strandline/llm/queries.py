"""The registered queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    """The vocabulary file that the contracts name; installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import language_id

    return language_id.identify(_table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import packing

    return packing.pack(_table(spark, sf_dir, "documents"), vocabulary())


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import near_dedup

    return near_dedup.groups(_table(spark, sf_dir, "documents"), shingle_words=4).drop("text_hash", "first")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import secrets

    return secrets.scan(_table(spark, sf_dir, "documents"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import pii

    return pii.find(_table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import exact_dedup

    return exact_dedup.dedup(_table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality

    return quality.judge(_table(spark, sf_dir, "documents")).drop("posterior")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import html_text

    return html_text.extract(_table(spark, sf_dir, "pages"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import mixing

    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import token_output

    folder = token_output.write(_table(spark, sf_dir, "documents"), vocabulary())
    return token_output.checksums(token_output.read(spark, folder, ("doc_id", "ids")))


def op11_filter_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import filter_audit

    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import simhash

    return simhash.groups(_table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import collocations

    return collocations.mine(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_best_fit_packing,
        op3_near_dedup,
        op4_secret_scan,
        op5_personal_data,
        op6_exact_dedup,
        op7_quality_rules,
        op8_html_text,
        op9_source_mixing,
        op10_token_output,
        op11_filter_interaction,
        op12_simhash,
        op13_collocations,
    )
}
#: Counts, votes and the rounds of expectation-maximisation over the counted patterns of votes.
_QUALITY_SQL = r"""
    WITH RECURSIVE t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS bare FROM documents),
    w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
    u AS (SELECT doc_id, unnest(words) AS a, unnest(range(1, len(words) + 1)) AS i FROM w),
    h AS (SELECT doc_id, i, a, lead(a) OVER o AS b, lead(a, 2) OVER o AS c FROM u WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM h WHERE c IS NOT NULL),
    r AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM g, range(3) AS o(k) WHERE n > 1 GROUP BY doc_id),
    f AS (SELECT w.doc_id, len(words)::BIGINT AS n_words, length(bare)::BIGINT AS word_chars, length(bare) - length(regexp_replace(bare, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(list_filter(lines, lambda x: regexp_matches(x, '[.!?"''”…][\x20\x09-\x0D]*\z'))) AS n_closed_lines,
        length(bare) - length(regexp_replace(bare, '\p{L}', '', 'g')) AS n_letters, length(bare) - length(regexp_replace(bare, '\p{Lu}', '', 'g')) AS n_upper,
        (length(bare) - length(replace(bare, '!!', ''))) // 2 AS n_exclaimed, coalesce(r.n_repeat_words, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN r USING (doc_id)),
    v AS MATERIALIZED (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, [
        CASE WHEN 10 * n_symbols > n_words THEN 0 WHEN 50 * n_symbols <= n_words THEN 2 ELSE 1 END,
        CASE WHEN 5 * n_repeat_words > n_words THEN 0 WHEN 20 * n_repeat_words <= n_words THEN 2 ELSE 1 END,
        CASE WHEN 4 * n_dup_lines > n_lines THEN 0 WHEN 10 * n_dup_lines <= n_lines THEN 2 ELSE 1 END,
        CASE WHEN 10 * n_upper > 3 * n_letters THEN 0 WHEN 10 * n_upper <= n_letters THEN 2 ELSE 1 END,
        CASE WHEN 20 * n_exclaimed > n_words THEN 0 WHEN 200 * n_exclaimed <= n_words THEN 2 ELSE 1 END,
        CASE WHEN 10 * n_letters < 7 * word_chars THEN 0 WHEN 10 * n_letters >= 9 * word_chars THEN 2 ELSE 1 END,
        CASE WHEN word_chars > 12 * n_words OR word_chars < 2 * n_words THEN 0 WHEN 2 * word_chars >= 7 * n_words AND word_chars <= 7 * n_words THEN 2 ELSE 1 END,
        CASE WHEN 10 * n_closed_lines < n_lines THEN 0 WHEN 10 * n_closed_lines >= 8 * n_lines THEN 2 ELSE 1 END] AS votes FROM f),
    p AS MATERIALIZED (SELECT list({'v': votes, 'n': n}) AS ps FROM (SELECT votes, (count(*) FILTER (NOT base_failed))::DOUBLE AS n FROM v GROUP BY votes)),
    em AS (SELECT 0 AS t, 0.8::DOUBLE AS prior, list_transform(range(24), lambda k: [0.05, 0.25, 0.7][k % 3 + 1]::DOUBLE) AS yes, list_transform(range(24), lambda k: [0.4, 0.3, 0.3][k % 3 + 1]::DOUBLE) AS no
      UNION ALL SELECT t + 1, (1 + list_sum(list_transform(q, lambda x: x.w))) / (2 + list_sum(list_transform(q, lambda x: x.n))),
        list_transform(range(24), lambda k: (2 * [0.05, 0.25, 0.7][k % 3 + 1] + list_sum(list_transform(q, lambda x: CASE WHEN x.v[k // 3 + 1] = k % 3 THEN x.w ELSE 0 END))) / (2 + list_sum(list_transform(q, lambda x: x.w)))),
        list_transform(range(24), lambda k: (2 * [0.4, 0.3, 0.3][k % 3 + 1] + list_sum(list_transform(q, lambda x: CASE WHEN x.v[k // 3 + 1] = k % 3 THEN x.n - x.w ELSE 0 END))) / (2 + list_sum(list_transform(q, lambda x: x.n - x.w))))
      FROM (SELECT t, list_transform(ps, lambda x: {'v': x.v, 'n': x.n, 'w': x.n / (1 + exp(-(ln(prior / (1 - prior)) + list_sum(list_transform(range(8), lambda j: ln(yes[3 * j + x.v[j + 1] + 1] / no[3 * j + x.v[j + 1] + 1]))))))}) AS q FROM em, p WHERE t < 30))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
      NOT base_failed AND ln(prior / (1 - prior)) + list_sum(list_transform(range(8), lambda j: ln(yes[3 * j + votes[j + 1] + 1] / no[3 * j + votes[j + 1] + 1]))) >= 0 AS kept
    FROM v, em WHERE em.t = 30"""

#: Words taken by the definition: a source's slots read its stream, in hashed order, up to the target and from the start again.
_MIXING_SQL = r"""
    WITH d AS (SELECT doc_id, source, len([x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''])::BIGINT AS size FROM documents),
    h AS (SELECT *, ('0x' || substr(md5(concat_ws('|', coalesce(doc_id::VARCHAR, ''), size::VARCHAR, coalesce(source, ''))), 1, 15))::BIGINT AS turn FROM d),
    s AS (SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM d GROUP BY source),
    o AS (SELECT *, row_number() OVER w AS place, (sum(source_size) OVER () - (sum(3 * source_size) OVER w - 3 * source_size))::DOUBLE / (sum(weight) OVER () - (sum(weight) OVER w - weight)) AS unit
        FROM s WINDOW w AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
    u AS (SELECT coalesce(arg_min(unit, place), 1e300) AS unit FROM o WHERE unit * weight <= 3 * source_size),
    t AS (SELECT source, source_size, least(3 * source_size, u.unit * weight)::DOUBLE AS target, round(least(3 * source_size, u.unit * weight))::BIGINT AS given FROM s, u),
    p AS (SELECT h.*, source_size, target, given, (sum(size) OVER (PARTITION BY h.source ORDER BY turn, doc_id, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS before
        FROM h JOIN t ON h.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target, CASE WHEN source_size = 0 THEN 0 ELSE given // source_size * size + greatest(0, least(size, given - given // source_size * source_size - before)) END::BIGINT AS taken FROM p"""

#: All pairs that share a shingle, their similarity on full sets, and what each document reaches over links.
_NEAR_SQL = r"""
    WITH RECURSIVE w AS (SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS words FROM documents),
    u AS (SELECT doc_id, unnest(words) AS a, unnest(range(1, len(words) + 1)) AS i, len(words) AS n FROM w),
    h AS (SELECT doc_id, i, n, a, lead(a) OVER o AS b, lead(a, 2) OVER o AS c, lead(a, 3) OVER o AS d FROM u WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    s AS MATERIALIZED (SELECT DISTINCT doc_id, concat_ws(' ', a, b, c, d) AS shingle FROM h WHERE i <= greatest(n - 3, 1)),
    n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY 1, 2),
    l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
    e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r(id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.other),
    c AS (SELECT id, min(other) AS component_id FROM r GROUP BY 1)
    SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM documents JOIN c ON c.id = doc_id LEFT JOIN n USING (doc_id)"""

#: Each document at each step of each order, by the filters that it fails.
_AUDIT_SQL = r"""
    WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
    w AS (SELECT *, [x FOR x IN string_split_regex(t, '[\x20\x09-\x0D]+') IF x <> ''] AS words, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
    l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY 1),
    f AS (SELECT part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic,
        concat(CASE WHEN len(words) < 200 THEN 'A' END, CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' END,
          CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 2 * length(t) THEN 'C' END, CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
          CASE WHEN doc_id > least THEN 'E' END) AS failed FROM w LEFT JOIN l USING (doc_id)),
    c AS MATERIALIZED (SELECT part, failed, good, toxic, count(*) AS n FROM f GROUP BY ALL),
    k AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS k),
    o AS (SELECT a.k || b.k || c.k || d.k || e.k AS filter_order FROM k a, k b, k c, k d, k e WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
    s AS (SELECT filter_order, step::INTEGER AS step, filter_order[step] AS own, left(filter_order, step - 1) AS earlier FROM o, range(1, 6) AS r(step)),
    x AS (SELECT *, contains(failed, own) AS fails, len(list_intersect(string_split(failed, ''), string_split(earlier, ''))) = 0 OR failed = '' AS alive FROM c, s),
    g AS (SELECT part, filter_order, step, own, sum(n) FILTER (alive AND NOT fails) AS kept, sum(n) FILTER (alive AND fails) AS removed, sum(n) FILTER (fails AND NOT alive) AS redundant,
        sum(n) FILTER (failed = own) AS unique_fails, sum(n) FILTER (alive AND fails AND good) AS good_lost, sum(n) FILTER (alive AND fails AND toxic) AS toxic_lost FROM x GROUP BY ALL)
    SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
      coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
      coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley FROM g"""

#: All phrases of two and three words counted as such, their cuts, and the longer phrases around them.
_PHRASE_SQL = r"""
    WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    w AS MATERIALIZED (SELECT lang, [x FOR x IN string_split_regex(piece, '[\x20\x09]+') IF x <> ''] AS words FROM p),
    u AS MATERIALIZED (SELECT lang, words[i] AS x, words[i + 1] AS y, words[i + 2] AS z FROM (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM w)),
    f1 AS MATERIALIZED (SELECT lang, x, count(*) AS f FROM u GROUP BY ALL),
    f2 AS MATERIALIZED (SELECT lang, x, y, count(*) AS f FROM u WHERE y IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
    f3 AS MATERIALIZED (SELECT lang, x, y, z, count(*) AS f FROM u WHERE z IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
    n AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY 1),
    i AS (SELECT lang, x, y, max(f) AS around FROM (SELECT lang, x, y, f FROM f3 UNION ALL SELECT lang, y, z, f FROM f3) GROUP BY 1, 2, 3),
    s AS (SELECT c.lang, c.x || ' ' || c.y AS phrase, c.f AS a, 1 AS k, l.f AS l, r.f AS r FROM f2 c JOIN f1 l ON l.lang = c.lang AND l.x = c.x JOIN f1 r ON r.lang = c.lang AND r.x = c.y
          LEFT JOIN i ON i.lang = c.lang AND i.x = c.x AND i.y = c.y WHERE i.around IS NULL OR 100 * i.around < 50 * c.f
        UNION ALL SELECT c.lang, c.x || ' ' || c.y || ' ' || c.z, c.f, 1, l.f, r.f FROM f3 c JOIN f1 l ON l.lang = c.lang AND l.x = c.x JOIN f2 r ON r.lang = c.lang AND r.x = c.y AND r.y = c.z
        UNION ALL SELECT c.lang, c.x || ' ' || c.y || ' ' || c.z, c.f, 2, l.f, r.f FROM f3 c JOIN f2 l ON l.lang = c.lang AND l.x = c.x AND l.y = c.y JOIN f1 r ON r.lang = c.lang AND r.x = c.z),
    t AS (SELECT s.lang, phrase, a, l, r, n.n, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM s JOIN n USING (lang) QUALIFY row_number() OVER (PARTITION BY s.lang, phrase ORDER BY score, k) = 1)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM t QUALIFY rank <= 2000"""

ORACLE_SQL: dict[str, str] = {
    "op3_near_dedup": _NEAR_SQL,
    "op9_source_mixing": _MIXING_SQL,
    "op7_quality_rules": _QUALITY_SQL,
    "op11_filter_interaction": _AUDIT_SQL,
    "op13_collocations": _PHRASE_SQL,
    "op6_exact_dedup": r"""
        WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS n_chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents),
        r AS (SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n_chars DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM n)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM r""",
}
