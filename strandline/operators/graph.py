"""A labelled property graph as DataFrames: loading, fan-out, merging, and checks.

Long form: nodes (label, id, props) and edges (label, src_id, src_label, dst_id, dst_label, props), props as JSON.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ids, text
from ..sources import schemas
from . import chains


# ---- nodes and edges of staging tables ----


def props(*columns: Column | str) -> Column:
    """A JSON object of the columns; nulls are left out, which is null again on reading."""
    return F.to_json(F.struct(*columns))


def nodes(df: DataFrame, label: str, node_id: Column, *columns: Column | str) -> DataFrame:
    return df.select(F.lit(label).alias("label"), node_id.alias("id"), props(*columns).alias("props"))


def load_nodes(df: DataFrame, label: str, node_id: Column, *columns: Column | str) -> tuple[DataFrame, DataFrame]:
    """Nodes with a valid prefix, and the rows skipped because theirs isn't."""
    good = node_id.isNotNull() & node_id.startswith(ids.PREFIXES[label])
    return nodes(df.where(F.coalesce(good, F.lit(False))), label, node_id, *columns), df.where(~F.coalesce(good, F.lit(False)))


def narrators(canonical: DataFrame) -> DataFrame:
    return nodes(canonical, "Narrator", ids.apply_prefix(F.col("canonical_id"), "nar:"), "name_ar", "name_en", "name_ar_normalized", "aliases", "birth_year_ah", "death_year_ah", "generation", "gender", "trustworthiness", "source_ids", "external_id", "mention_count")


def hadiths(staged: DataFrame) -> DataFrame:
    return nodes(staged, "Hadith", ids.hadith_id(F.col("source_id")), "matn_ar", "matn_en", "isnad_raw_ar", "isnad_raw_en", "grade", text.normalize_grade(F.col("grade")).alias("grade_normalized"), "source_corpus", "sect", "collection_name", "chapter_name_ar", "chapter_name_en")


def collections(staged: DataFrame) -> DataFrame:
    return nodes(staged, "Collection", ids.apply_prefix(F.col("collection_id"), "col:"), "name_ar", "name_en", "compiler_name", "compilation_year_ah", "sect", "total_hadiths", "source_corpus")


def chain_nodes(mentions: DataFrame) -> DataFrame:
    listed = chains.ordered_ids(mentions, "hadith_id", ("position_in_chain", "mention_id"), "canonical_narrator_id")
    return nodes(listed, "Chain", F.concat(F.lit("chn:"), "hadith_id", F.lit("-0")), ids.hadith_id(F.col("hadith_id")).alias("hadith_id"), F.lit(0).alias("chain_index"), F.size("member_ids").alias("chain_length"), (F.size("member_ids") > 0).alias("is_complete"), F.col("member_ids").alias("narrator_ids"))


def gradings(staged: DataFrame) -> DataFrame:
    graded = staged.where("grade <> ''")
    return nodes(graded, "Grading", ids.grading_id(F.col("source_id")), ids.hadith_id(F.col("source_id")).alias("hadith_id"), "grade", text.normalize_grade(F.col("grade")).alias("grade_normalized"), F.col("collection_name").alias("scholar_name"))


def curated_nodes(rows: DataFrame, label: str) -> DataFrame:
    return nodes(rows, label, ids.apply_prefix(F.col("id").cast("string"), ids.PREFIXES[label]), *(c for c in rows.columns if c != "id"))


def edges(df: DataFrame, label: str, src: tuple[str, Column], dst: tuple[str, Column], *columns: Column | str) -> DataFrame:
    return df.select(
        F.lit(label).alias("label"), src[1].alias("src_id"), F.lit(src[0]).alias("src_label"), dst[1].alias("dst_id"), F.lit(dst[0]).alias("dst_label"),
        (props(*columns) if columns else F.lit("{}")).alias("props"),
    )


def transmitted(mentions: DataFrame) -> DataFrame:
    found = chains.pairs(mentions, "hadith_id", ("position_in_chain", "mention_id"), "canonical_narrator_id")
    return edges(found, "TRANSMITTED_TO", ("Narrator", F.col("from_id")), ("Narrator", F.col("to_id")), F.col("position").alias("position_in_chain"), ids.hadith_id(F.col("hadith_id")).alias("hadith_id")).distinct()


def narrated(mentions: DataFrame) -> DataFrame:
    first = chains.first_member(mentions, "hadith_id", ("position_in_chain", "mention_id"), "canonical_narrator_id")
    return edges(first, "NARRATED", ("Narrator", F.col("first_id")), ("Hadith", ids.hadith_id(F.col("hadith_id"))))


def appears_in(staged: DataFrame, order: str | None = None) -> DataFrame:
    """One edge for each hadith and collection; of each fact the last by ``order`` that isn't null, the greatest without one."""
    target = F.concat_ws("", F.lit("col:"), F.concat_ws(":", "source_corpus", "collection_name"))
    kept = {"book_number": "book_number", "chapter_number": "chapter_number", "hadith_number_in_book": "hadith_number"}
    pairs = staged.select(ids.hadith_id(F.col("source_id")).alias("src"), target.alias("dst"), *(F.col(c).alias(n) for n, c in kept.items()), *([order] if order else []))
    place = F.col(order) if order else F.struct(*kept)
    latest = [F.max_by(n, F.when(F.col(n).isNotNull(), place)).alias(n) for n in kept]
    return edges(pairs.groupBy("src", "dst").agg(*latest), "APPEARS_IN", ("Hadith", F.col("src")), ("Collection", F.col("dst")), *kept)


def parallel_of(links: DataFrame) -> DataFrame:
    a, b = ids.hadith_id(F.col("hadith_id_a")), ids.hadith_id(F.col("hadith_id_b"))
    return edges(links, "PARALLEL_OF", ("Hadith", F.least(a, b)), ("Hadith", F.greatest(a, b)), "similarity_score", "variant_type", "cross_sect").distinct()


def studied_under(network: DataFrame, canonical: DataFrame) -> DataFrame:
    known = canonical.select(F.explode("source_ids").alias("bio"), F.col("canonical_id").alias("cid"))
    src = known.select(F.concat(F.lit("muhaddithat:"), F.regexp_replace("bio", "^[^:]*:", "")).alias("k"), "cid").groupBy("k").agg(F.min("cid").alias("cid"))
    named = network.withColumn("kf", F.concat_ws(":", "source", "from_external_id")).withColumn("kt", F.concat_ws(":", "source", "to_external_id"))
    joined = named.join(src.toDF("kf", "f"), "kf").join(src.toDF("kt", "t"), "kt")
    return edges(joined, "STUDIED_UNDER", ("Narrator", F.col("f")), ("Narrator", F.col("t")), "source").distinct()


def graded_by(staged: DataFrame) -> DataFrame:
    return edges(staged.where("grade <> ''"), "GRADED_BY", ("Hadith", ids.hadith_id(F.col("source_id"))), ("Grading", ids.grading_id(F.col("source_id"))))


# ---- fan-out of raw rows ----


def fan_out(rows: DataFrame, order: str = "source_id", placed: bool = False) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of staged rows: streaming identities, English chains before Arabic ones. Of nodes with the same id the first
    stays, by ``order`` and the place in the row. Rows are read once for the nodes and once for the edges, and chains are cut once.
    ``placed``: each with its row's ``order`` as ``place``, and its number ``k`` in the row."""
    hid, cid = ids.hadith_id(F.col("source_id")), ids.stream_collection_id(F.col("collection_name"))
    english = F.coalesce(F.col("isnad_raw_en"), F.lit("")) != ""
    spans = F.when(english, chains.spans(F.col("isnad_raw_en"), "en")).otherwise(chains.spans(F.col("isnad_raw_ar"), "ar"))
    base = rows.withColumns({"hid": hid, "cid": cid, "english": english, "spans": spans, "place": F.col(order)})

    def named(s: Column) -> Column:
        en, ar = F.when(F.col("english"), s["name"]), F.when(~F.col("english"), s["name"])
        plain = text.normalize_arabic(ar)
        return F.struct(ids.stream_narrator_id(en, plain).alias("nid"), en.alias("name_en"), ar.alias("name_ar"), plain.alias("name_ar_normalized"), s["method"].alias("transmission_method"))

    people = base.withColumn("people", F.transform("spans", named)).withColumn("members", F.transform("people", lambda s: s["nid"]))
    graded = F.coalesce(F.col("grade") != "", F.lit(False))
    gid, grade = F.concat(F.lit("grd:"), F.col("hid")), text.normalize_grade(F.col("grade")).alias("grade_normalized")

    def node(label: str, node_id: Column, *columns: Column | str) -> Column:
        return F.struct(F.lit(label).alias("label"), node_id.alias("id"), props(*columns).alias("props"))

    def edge(label: str, src: tuple[str, Column], dst: tuple[str, Column], *columns: Column | str) -> Column:
        own = props(*columns) if columns else F.lit("{}")
        return F.struct(F.lit(label).alias("label"), src[1].alias("src_id"), F.lit(src[0]).alias("src_label"), dst[1].alias("dst_id"), F.lit(dst[0]).alias("dst_label"), own.alias("props"))

    size, chain_id = F.size("members"), F.concat(F.lit("chn:"), ids.sha1_24(F.concat_ws("|", "hid", "members")))
    one = [
        node("Hadith", F.col("hid"), "matn_ar", "matn_en", "isnad_raw_ar", "isnad_raw_en", "grade", grade, "source_corpus", "sect", "collection_name", "chapter_name_ar", "chapter_name_en"),
        node("Collection", F.col("cid"), F.col("collection_name").alias("name_en"), "sect", "source_corpus"),
        node("Chain", chain_id, F.col("hid").alias("hadith_id"), F.lit(0).alias("chain_index"), size.alias("chain_length"), (size > 0).alias("is_complete"), F.col("members").alias("narrator_ids")),
        F.when(graded, node("Grading", gid, F.col("hid").alias("hadith_id"), "grade", grade, F.col("collection_name").alias("scholar_name"))),
    ]
    narrators_ = F.transform("people", lambda s: node("Narrator", s["nid"], s["name_en"].alias("name_en"), s["name_ar"].alias("name_ar"), s["name_ar_normalized"].alias("name_ar_normalized"), s["transmission_method"].alias("transmission_method")))
    every = people.select("place", F.posexplode(F.concat(F.array(*one), narrators_)).alias("k", "n")).where("n IS NOT NULL")
    first = every.groupBy("n.label", "n.id").agg(F.min(F.struct("place", "k", "n.props")).alias("first"))
    where = ["place", "k"] if placed else []
    all_nodes = first.select("label", "id", "first.props", *(f"first.{c}" for c in where))

    following = F.transform(
        F.when(size > 1, F.sequence(F.lit(0), size - 2)).otherwise(F.array().cast("array<int>")),
        lambda k: edge("TRANSMITTED_TO", ("Narrator", F.get("members", k)), ("Narrator", F.get("members", k + 1)), k.alias("position_in_chain"), F.col("hid").alias("hadith_id")),
    )
    single = [
        edge("APPEARS_IN", ("Hadith", F.col("hid")), ("Collection", F.col("cid")), "book_number", "chapter_number", F.col("hadith_number").alias("hadith_number_in_book")),
        F.when(size > 0, edge("NARRATED", ("Narrator", F.get("members", 0)), ("Hadith", F.col("hid")))),
        F.when(graded, edge("GRADED_BY", ("Hadith", F.col("hid")), ("Grading", gid))),
    ]
    all_edges = people.select("place", F.posexplode(F.concat(F.array(*single), following)).alias("k", "e")).where("e IS NOT NULL").select("e.*", *where)
    return all_nodes, all_edges


# ---- upserts ----


def merge_overwrite(old: DataFrame, new: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The last row of each key; later values replace all of the earlier ones, nulls too."""
    both = old.unionByName(new)
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(order).desc()))
    return both.withColumn("__nth", last).where("__nth = 1").drop("__nth")


def merge_coalesce(old: DataFrame, new: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """For each key and column the last value that is not null: a null never clears anything."""
    both = old.unionByName(new)
    values = [c for c in both.columns if c not in (*keys, order)]
    latest = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in values]
    return both.groupBy(*keys).agg(*latest, F.max(order).alias(order))


class MissingEndpoints(ValueError):
    """Edges whose nodes don't exist."""


def with_endpoints(links: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges whose both nodes exist, and the others."""
    src = known.select(F.col("label").alias("src_label"), F.col("id").alias("src_id")).distinct()
    dst = known.select(F.col("label").alias("dst_label"), F.col("id").alias("dst_id")).distinct()
    tested = links.join(src.withColumn("__s", F.lit(True)), ["src_label", "src_id"], "left").join(dst.withColumn("__d", F.lit(True)), ["dst_label", "dst_id"], "left")
    both = F.col("__s").isNotNull() & F.col("__d").isNotNull()
    return tested.where(both).select(*links.columns), tested.where(~both).select(*links.columns)


def require_endpoints(links: DataFrame, known: DataFrame) -> DataFrame:
    _, bad = with_endpoints(links, known)
    lost = bad.groupBy("label").count().collect()  # one row for each label at most
    if lost:
        raise MissingEndpoints(", ".join(f"{r['label']}: {r['count']}" for r in lost))
    return links  # none is lost, so they needn't be joined again


@dataclass(frozen=True)
class LoadResult:
    created: int
    merged: int
    skipped: int = 0


def load_result(existing: DataFrame, new: DataFrame, keys: Sequence[str], skipped: int = 0) -> LoadResult:
    distinct = new.select(*keys).distinct()
    total = distinct.count()
    created = distinct.join(existing.select(*keys).distinct(), list(keys), "left_anti").count()
    return LoadResult(created, total - created, skipped)


def shape_props(df: DataFrame, allowed: dict[str, str]) -> DataFrame:
    """Rows with only the properties that their label may carry; a label that isn't known raises."""
    unknown = [r["label"] for r in df.where(~F.col("label").isin(*allowed)).select("label").distinct().limit(20).collect()]
    if unknown:
        raise ValueError(f"unknown labels: {', '.join(sorted(unknown))}")
    pairs = F.map_entries(F.from_json("props", "map<string,string>"))
    names = F.create_map(*(F.lit(x) for label, text_ in allowed.items() for x in (label, text_)))
    ok = F.split(F.element_at(names, F.col("label")), " ")
    return df.withColumn("props", F.to_json(F.map_from_entries(F.filter(pairs, lambda e: F.array_contains(ok, e["key"])))))


def with_topics(nodes_: DataFrame, topics: DataFrame, key: str = "id") -> DataFrame:
    """Hadith nodes with the topics and scores found for them among their properties; other nodes, and those without topics, as they are."""
    fields = [c for c in topics.columns if c.startswith("topic_")]
    entries = F.map_from_entries(F.array_compact(F.array(*(F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value"))) for c in fields))))
    found = topics.dropDuplicates([key]).select(F.col(key).alias("topic_of"), F.lit("Hadith").alias("topic_label"), entries.alias("new"))
    joined = nodes_.join(found, (F.col("id") == F.col("topic_of")) & (F.col("label") == F.col("topic_label")), "left")
    rest = F.map_filter(F.from_json("props", "map<string,string>"), lambda k, _: ~k.isin(*fields))
    return joined.withColumn("props", F.when(F.col("new").isNotNull(), F.to_json(F.map_concat(rest, "new"))).otherwise(F.col("props"))).select(*nodes_.columns)


# ---- checks ----


def orphans(nodes_: DataFrame, links: DataFrame) -> DataFrame:
    """Nodes without any edge."""
    ends = links.select(F.col("src_label").alias("label"), F.col("src_id").alias("id")).union(links.select("dst_label", "dst_id")).distinct()
    return nodes_.join(ends, ["label", "id"], "left_anti")


def coverage(groups: DataFrame, members: DataFrame, key: str, member: str, expected: str) -> DataFrame:
    """Members of each group, groups without any too, with the deviation from what is expected."""
    counted = groups.join(members, key, "left").groupBy(key, expected).agg(F.count(member).alias("actual"))
    return counted.withColumn("deviation", F.when(F.col(expected) != 0, F.abs(F.col("actual") - F.col(expected)) * 100.0 / F.col(expected)))


def _trimmed(edges_: DataFrame, keep: Callable[[DataFrame, int], DataFrame]) -> DataFrame:
    """Edges without those that lead out of a node without a way in, or into one without a way out, until all others have both."""
    n, before = edges_.count(), -1
    while n and n != before:
        sources, targets = edges_.select(F.col("src_id").alias("dst_id")).distinct(), edges_.select(F.col("dst_id").alias("src_id")).distinct()
        edges_ = keep(edges_.join(targets, "src_id", "left_semi").join(sources, "dst_id", "left_semi").select("src_id", "dst_id"), 0)
        before, n = n, edges_.count()
    return edges_


def strong_components(links: DataFrame, keep: Callable[[DataFrame, int], DataFrame]) -> DataFrame:
    """(id, component, size) of every node that edges touch: nodes that reach each other share the smallest id among them.

    Nodes on no cycle are peeled off, from both sides at once, so a graph without cycles ends there. In what is left, each node takes
    the greatest id that reaches it; the nodes of a colour that reach back to the node it is named after are one component. Those
    go, and the rest is trimmed again. A step is a join over edges; there are as many as the paths are long.
    """
    every = links.select("src_id", "dst_id").distinct()
    nodes_ = keep(every.select(F.col("src_id").alias("id")).union(every.select("dst_id")).distinct(), 0)
    left, found = _trimmed(keep(every.where("src_id <> dst_id"), 0), keep), []
    while not left.isEmpty():
        colours = left.select(F.col("src_id").alias("id")).distinct().withColumn("colour", F.col("id"))
        changed = True
        while changed:
            arriving = left.join(colours.withColumnRenamed("id", "src_id"), "src_id").groupBy(F.col("dst_id").alias("id")).agg(F.max("colour").alias("new"))
            after = keep(colours.join(arriving, "id", "left").select("id", F.greatest("colour", "new").alias("colour"), (F.col("new") > F.col("colour")).alias("grew")), 0)
            changed, colours = not after.where("grew").isEmpty(), after.drop("grew")
        a, b = colours.toDF("src_id", "colour"), colours.toDF("dst_id", "other")
        inner = keep(left.join(a, "src_id").join(b, "dst_id").where("colour = other").select("src_id", "dst_id", "colour"), 0)
        reached = frontier = keep(colours.where("id = colour"), 0)
        while not frontier.isEmpty():
            back = inner.join(frontier.select(F.col("id").alias("dst_id")), "dst_id", "left_semi").select(F.col("src_id").alias("id"), "colour").distinct()
            frontier = keep(back.join(reached, "id", "left_anti"), 0)
            reached = keep(reached.union(frontier), 0)
        found.append(reached)
        gone = reached.select("id")
        rest = left.join(gone.toDF("src_id"), "src_id", "left_anti").join(gone.toDF("dst_id"), "dst_id", "left_anti")
        left = _trimmed(keep(rest.select("src_id", "dst_id"), 0), keep)
    grouped = nodes_.select("id", F.col("id").alias("colour")).limit(0)
    for part in found:
        grouped = grouped.union(part.select("id", "colour"))
    least = grouped.groupBy("colour").agg(F.min("id").alias("component"), F.count("*").alias("size"))
    named = grouped.join(least, "colour").select("id", "component", "size")
    return nodes_.join(named, "id", "left").select("id", F.coalesce("component", "id").alias("component"), F.coalesce("size", F.lit(1)).cast("long").alias("size"))


def within_components(links: DataFrame, keep: Callable[[DataFrame, int], DataFrame]) -> DataFrame:
    """Edges that lie on some cycle: those whose nodes are in the same component."""
    found = keep(strong_components(links, keep).select("id", "component"), 0)
    a, b = found.toDF("src_id", "component"), found.toDF("dst_id", "other")
    return links.join(a, "src_id").join(b, "dst_id").where("component = other").select(*links.columns)


def cycles(links: DataFrame, depth: int = 20, limit: int | None = 100, keep: Callable[[DataFrame, int], DataFrame] | None = None) -> DataFrame:
    """Paths (src, dst) of at most ``depth`` edges, none of them twice, that come back to their start: one join a step,
    over edges within strongly connected components only, and only paths that can still grow go on. Of more than ``limit``, the shortest count, by start and trail: once there are
    so many, longer ones can't be among them. ``keep`` may cut lineage between steps.
    """
    edges_ = links.select(F.col("src_id"), F.col("dst_id")).distinct()
    edges_ = keep(within_components(edges_, keep), 0) if keep else edges_
    edges_ = edges_.withColumn("edge", F.concat_ws(">", F.col("src_id").cast("string"), F.col("dst_id").cast("string")))
    paths = edges_.select(F.col("src_id").alias("start"), F.col("dst_id").alias("at"), F.array("edge").alias("trail"))
    found, n = [], 0
    for k in range(1, depth + 1):
        found.append(paths.where("start = at").select("start", F.lit(k).alias("length"), "trail"))
        if k == depth:
            break
        if paths.isEmpty():
            break
        if limit:
            n += found[-1].count()
            if n >= limit:
                break
        grown = paths.join(edges_, paths["at"] == edges_["src_id"]).where(~F.array_contains("trail", F.col("edge")))
        paths = grown.select("start", F.col("dst_id").alias("at"), F.concat("trail", F.array("edge")).alias("trail"))
        paths = keep(paths, k) if keep else paths
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out.orderBy("length", "start", "trail").limit(limit) if limit else out


Classifier = Callable[[DataFrame], bool]
_CLASSIFIERS: dict[str, Classifier] = {}


def register_classifier(name: str, passes: Classifier) -> None:
    """How the result of a named check is judged; without one, a check passes if it finds no rows."""
    _CLASSIFIERS[name] = passes


register_classifier("collection_coverage", lambda df: df.where("deviation > 10").isEmpty())


def validate(checks: dict[str, DataFrame]) -> dict[str, bool]:
    return {name: _CLASSIFIERS.get(name, lambda df: df.isEmpty())(df) for name, df in checks.items()}
