"""People resolved against biographies: exact, blocked fuzzy and cross-reference matches, decided in chain order.

Distinct names are far fewer than mentions, so candidates are joined per name, with equality on the name or on its first two
letters; cheap bounds on lengths come before the alignment. Only chains where a fuzzy candidate can depend on
earlier decisions are folded in order; all others are decided row by row.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ids, similarity, text

#: Thresholds of the stages.
FUZZY_RATIO, MAX_DISTANCE, CONFIDENCE, CROSSREF_RATIO = 80, 2, 0.70, 60
MIN_GAP, MAX_GAP = 15, 80


def exact_matches(names: DataFrame, bios: DataFrame) -> DataFrame:
    """(name, cand, stage, score, branch): equal normalised names first, then equal lower-cased English names."""
    arabic = names.join(bios, F.col("name") == F.col("name_ar_normalized")).select("name", "cand", F.lit(0).alias("branch"))
    english = names.join(bios, F.lower("name") == F.lower(F.trim("name_en"))).select("name", "cand", F.lit(1).alias("branch"))
    return arabic.union(english).select("name", "cand", F.lit("exact").alias("stage"), F.lit(1.0).alias("score"), "branch")


def fuzzy_matches(names: DataFrame, bios: DataFrame) -> DataFrame:
    """Same first two letters, distance at most 2, ratio at least 80. Blocks are of two letters and a length: each name joins
    the lengths within the distance."""
    a, b = F.col("name"), F.col("name_ar_normalized")
    lengths = F.explode(F.sequence(F.length(a) - MAX_DISTANCE, F.length(a) + MAX_DISTANCE))
    left = names.select("name", text.prefix_key(a).alias("block"), lengths.alias("size"))
    right = bios.where("name_ar_normalized <> ''").select("cand", "name_ar_normalized", text.prefix_key(b).alias("block"), F.length(b).alias("size"))
    near = left.join(right, ["block", "size"]).where(similarity.within_distance(a, b, MAX_DISTANCE)).withColumn("ratio", similarity.indel_ratio_batched(a, b))
    return near.where(F.col("ratio") >= FUZZY_RATIO).select("name", "cand", F.lit("fuzzy").alias("stage"), F.bround(F.col("ratio") / 100, 4).alias("score"), F.lit(2).alias("branch"))


def crossref_matches(names: DataFrame, bios: DataFrame) -> DataFrame:
    """Same first two letters, candidate with an external id, ratio at least 60."""
    a, b = F.col("name"), F.col("name_ar_normalized")
    block = (text.prefix_key(a) == text.prefix_key(b)) & (similarity.ratio_bound(a, b) >= CROSSREF_RATIO)
    near = names.join(bios.where("name_ar_normalized <> '' AND external_id <> ''"), block).withColumn("ratio", similarity.indel_ratio_batched(a, b))
    return near.where(F.col("ratio") >= CROSSREF_RATIO).select("name", "cand", F.lit("crossref").alias("stage"), F.bround(F.col("ratio") / 100, 4).alias("score"), F.lit(3).alias("branch"))


def _shorter(word: Column, letters: int) -> Column:
    """All strings that ``letters`` deletions leave of the word, each once; the empty one if it has no more."""
    level = F.array(word)
    for _ in range(letters):
        places = lambda w: F.when(F.length(w) > 0, F.sequence(F.lit(1), F.length(w))).otherwise(F.array(F.lit(1)))
        cut = lambda w: F.transform(places(w), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w))))
        level = F.array_distinct(F.flatten(F.transform(level, cut)))
    return level


def _signature(word: Column, parts: int) -> Column:
    """A number with some bits for each part of the word: part k has the letters in places k, k + parts, and so on."""
    letters = F.transform(F.sequence(F.lit(1), F.greatest(F.length(word), F.lit(1))), lambda i: F.substring(word, i, F.lit(1)))
    bits = 60 // parts
    own = lambda k: F.array_join(F.filter(letters, lambda _, i: i % parts == k), "")
    return sum((F.shiftleft(F.xxhash64(own(k)).bitwiseAND((1 << bits) - 1), k * bits) for k in range(1, parts)), F.xxhash64(own(0)).bitwiseAND((1 << bits) - 1))


def _left_out(word: Column, lengths: list[int], most: int) -> Column:
    """Hashes of the strings that a pair with this word and one of another of ``lengths`` share if letters are put in or left out between them: with ``e`` letters between
    the lengths, the shorter loses ``most - e`` of them, or ``most - 1`` if e is 0, and the longer as many and ``e``."""
    n, found = F.length(word), F.array().cast("array<bigint>")

    def hashed_with(e: int) -> Callable[[Column], Column]:
        return lambda d: F.xxhash64(d, F.greatest(n, n + e), F.least(n, n + e))

    for e in range(-most, most + 1):
        less = most - abs(e) if e else most - 1
        if e or less:
            hashed = F.transform(_shorter(word, less + max(-e, 0)), hashed_with(e))
            found = F.concat(found, F.when(F.array_contains(F.lit(lengths), n + e), hashed).otherwise(F.array().cast("array<bigint>")))
    return F.array_distinct(found)


def _near(x: DataFrame, y: DataFrame, a: str, b: str, most: int) -> DataFrame:
    """All pairs of a row of ``x`` and one of ``y`` (distinct strings) at most ``most`` edits apart, each once.

    Strings of one length whose signatures differ in at most ``most`` of three times as many parts meet on the other parts, on the first choice of parts that covers
    those; others that are near differ by letters put in or left out, and meet on the least hash of what deletions leave of both. So no pair is
    made twice, none has to be made distinct, and pairs can be counted where they are met."""
    parts = 3 * most
    choices, bits = list(itertools.combinations(range(parts), most)), 60 // parts
    first = [next((n for n, c in enumerate(choices) if all(k in c for k in range(parts) if m >> k & 1)), -1) for m in range(1 << parts)]
    sizes = [[r[0] for r in df.select(F.length(c)).distinct().collect()] for df, c in ((x, a), (y, b))]

    def keyed(df: DataFrame, c: str, lengths: list[int]) -> DataFrame:
        word, outside = F.col(c), [(1 << 60) - 1 - sum(((1 << bits) - 1) << k * bits for k in choice) for choice in choices]
        signed = df.withColumn("signature", _signature(word, parts))
        same = F.when(F.array_contains(F.lit(lengths), F.length(word)), F.array(*(F.xxhash64(F.col("signature").bitwiseAND(o), F.length(word), F.lit(n)) for n, o in enumerate(outside))))
        keys = F.concat(F.coalesce(same, F.transform(F.lit(list(range(len(choices)))), lambda _: F.lit(None).cast("bigint"))), _left_out(word, lengths, most))
        dealt = signed.repartition(-(-tasks // 4), c).select(*df.columns, "signature", F.posexplode(keys).alias("n", "key")).where("key IS NOT NULL")
        dealt = dealt.select("key", F.least("n", F.lit(len(choices))).cast("short").alias("n"), "signature", *df.columns).repartition(tasks, "key")
        return dealt.withColumn("keys", F.when(F.col("n") == len(choices), _left_out(word, lengths, most)))

    tasks = max(1, -(-(x.count() + y.count()) // 4000))
    left = keyed(x, a, sizes[1])
    right = keyed(y, b, sizes[0]).select("key", *(F.col(c).alias(f"{c}_") for c in ("n", "signature", "keys")), *y.columns)
    apart = F.col("signature").bitwiseXOR(F.col("signature_"))
    mask = sum((F.when(apart.bitwiseAND(((1 << bits) - 1) << k * bits) != 0, 1 << k).otherwise(0) for k in range(1, parts)), F.when(apart.bitwiseAND((1 << bits) - 1) != 0, 1).otherwise(0))
    alike = (F.length(a) == F.length(b)) & (F.bit_count(mask) <= most)
    chosen = F.when(F.col("n") < len(choices), F.get(F.lit(first), mask) == F.col("n")).otherwise(~alike)
    # rows are dealt by key alone, so n is compared but not joined on
    met = left.join(right.hint("merge"), "key").where((F.col("n") - F.col("n_") == 0) & chosen & similarity.within_distance(F.col(a), F.col(b), most))
    met = met.where((F.col("n") < len(choices)) | (F.array_min(F.array_intersect("keys", "keys_")) == F.col("key")))
    return met.select(*x.columns, *y.columns)


def within_deletions(names: DataFrame, others: DataFrame, a: str, b: str, most: int = MAX_DISTANCE) -> DataFrame:
    """All pairs of a row of ``names`` and one of ``others`` whose strings ``a`` and ``b`` are at most ``most`` edits apart, without blocks by first letters.

    Distinct strings are joined, on hashes, then the rows; the distance decides. Spark takes the keys for a table as small as the
    strings and would broadcast them, through the driver, or join them in one task, so the join is told to merge, in tasks by the number of strings."""
    x, y = names.select(a).where(F.col(a).isNotNull()).distinct(), others.select(b).where(F.col(b).isNotNull()).distinct()
    return names.join(_near(x, y, a, b, most).hint("merge"), a).join(others, b)


def near_counts(names: DataFrame, column: str, most: int = MAX_DISTANCE) -> DataFrame:
    """(column, near): how many pairs of rows have the string on the left and another, at most ``most`` edits apart, on the right; strings without any are left out. Pairs are
    counted where they are met and never shuffled."""
    x = names.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    y = x.select(F.col(column).alias("other_"), F.col("rows").alias("others_"))
    pairs = _near(x, y, column, "other_", most).where(F.col(column) != F.col("other_"))
    return pairs.groupBy(column).agg(F.sum(F.col("rows") * F.col("others_")).alias("near"))


def unblocked_fuzzy(names: DataFrame, bios: DataFrame) -> DataFrame:
    """The fuzzy stage without blocks: distance at most 2 and ratio at least 80, whatever the first letters."""
    a, b = F.col("name"), F.col("name_ar_normalized")
    near = within_deletions(names, bios.where("name_ar_normalized <> ''"), "name", "name_ar_normalized").withColumn("ratio", similarity.indel_ratio_batched(a, b))
    return near.where(F.col("ratio") >= FUZZY_RATIO).select("name", "cand", F.bround(F.col("ratio") / 100, 4).alias("score"))


def _decide(chain: Column) -> Column:
    """Folds a chain's mentions in order. ``years`` has the death year of the person decided on at each position; a fuzzy
    candidate with a year stays if no neighbour has one, or if a neighbour's lies 15 to 80 years away."""

    def plausible(year: Column, years: Column) -> Column:
        near = F.filter(years, lambda y: y.isNotNull())
        return (F.size(near) == 0) | year.isNull() | F.exists(near, lambda y: similarity.plausible_gap(year, y, MIN_GAP, MAX_GAP))

    def year_at(state: Column, position: Column) -> Column:
        hits = F.filter(state["decided"], lambda d: d["pos"] == position)
        return F.element_at(F.concat(F.array(F.lit(None).cast("int")), F.transform(hits, lambda d: d["year"])), -1)

    def step(state: Column, m: Column) -> Column:
        def decide(pool: Column) -> Column:
            best = F.get(pool, 0)
            accepted = F.coalesce(best["score"] >= CONFIDENCE, F.lit(False))
            more = F.array(F.struct(m["pos"].alias("pos"), best["year"].alias("year")))
            row = F.struct(m["mention_id"].alias("mention_id"), F.when(accepted, best).alias("best"), pool.alias("pool"))
            return F.struct(F.when(accepted, F.concat(state["decided"], more)).otherwise(state["decided"]).alias("decided"), F.concat(state["out"], F.array(row)).alias("out"))

        def filtered(years: Column) -> Column:
            return F.filter(m["cands"], lambda c: (c["stage"] != "fuzzy") | plausible(c["year"], years))

        years = F.array(year_at(state, m["pos"] - 1), year_at(state, m["pos"] + 1))
        return _let(years, lambda y: _let(filtered(y), lambda kept: _let(_pool(kept), decide)))

    cand = "struct<cand:bigint,stage:string,score:double,year:int>"
    start = F.struct(
        F.array().cast("array<struct<pos:int,year:int>>").alias("decided"),
        F.array().cast(f"array<struct<mention_id:string,best:{cand},pool:array<{cand}>>>").alias("out"),
    )
    return F.aggregate(chain, start, step)["out"]


def _pool(kept: Column) -> Column:
    """The candidates of the first stage that has any."""
    exact, fuzzy, cross = (_of(kept, stage) for stage in ("exact", "fuzzy", "crossref"))
    return F.when(F.size(exact) > 0, exact).when(F.size(fuzzy) > 0, fuzzy).otherwise(cross)


def _decide_alone(cands: Column) -> Column:
    """The decision on a mention that depends on no other."""

    def decide(pool: Column) -> Column:
        best = F.get(pool, 0)
        return F.struct(F.when(F.coalesce(best["score"] >= CONFIDENCE, F.lit(False)), best).alias("best"), pool.alias("pool"))

    return _let(_pool(cands), decide)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def _of(cands: Column, stage: str) -> Column:
    return F.filter(cands, lambda c: c["stage"] == stage)


def resolve(mentions: DataFrame, bios: DataFrame, keep: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Canonical people, ambiguous mentions with their three best candidates, and the log of accepted matches.

    ``mentions``: mention_id, hadith_id, source_corpus, position_in_chain, name_raw, name_normalized, and ``ord``, their order.
    ``bios``: columns of biographies and ``cand``, their order. ``keep`` stores what is used more than once: with the candidates of the
    distinct names stored, Spark knows their size and broadcasts them if they are small. The mentions themselves are shuffled once, by chain.
    """
    raw = F.coalesce(F.nullif("name_normalized", F.lit("")), F.col("name_raw"))
    named = mentions.withColumn("mention_text", F.coalesce(raw, F.lit(""))).withColumn("name", text.normalize_arabic(F.col("mention_text")))
    names = named.where("name <> ''").select("name").distinct()
    names = keep(names) if keep else names
    exact = exact_matches(names, bios)
    rest = names.join(exact.select("name").distinct(), "name", "left_anti")
    found = exact.union(fuzzy_matches(rest, bios)).union(crossref_matches(rest, bios)).join(bios.select("cand", "death_year_ah"), "cand")
    ordered = F.array_sort(F.collect_list(F.struct("branch", (-F.col("score")).alias("neg"), "cand", "stage", "score", F.col("death_year_ah").alias("year"))))
    lists = found.groupBy("name").agg(F.transform(ordered, lambda c: F.struct(c["cand"], c["stage"], c["score"], c["year"])).alias("cands"))
    lists = keep(lists) if keep else lists
    none = F.array().cast("array<struct<cand:bigint,stage:string,score:double,year:int>>")
    facts = ["mention_id", "mention_text", "source_corpus", "ord"]
    placed = named.select("hadith_id", "position_in_chain", "name", *facts).join(lists, "name", "left").withColumn("cands", F.coalesce("cands", none))
    # only chains with a fuzzy candidate that has a year depend on earlier decisions; mentions of no chain are each alone
    dependent = F.exists("cands", lambda c: (c["stage"] == "fuzzy") & c["year"].isNotNull())
    chain = F.array_sort(F.collect_list(F.struct("ord", F.col("position_in_chain").alias("pos"), "mention_id", "cands", "mention_text", "source_corpus")))
    chained = placed.where("hadith_id IS NOT NULL").groupBy("hadith_id").agg(chain.alias("chain"), F.max(dependent).alias("dependent"))
    single = F.transform("chain", lambda m: F.struct(m["mention_id"].alias("mention_id"), _decide_alone(m["cands"]).alias("d")))
    single = F.transform(single, lambda m: F.struct(m["mention_id"].alias("mention_id"), m["d"]["best"].alias("best"), m["d"]["pool"].alias("pool")))
    both = F.zip_with("chain", F.when(F.col("dependent"), _decide(F.col("chain"))).otherwise(single), lambda m, d: F.struct(*(m[c].alias(c) for c in facts), d["best"].alias("best"), d["pool"].alias("pool")))
    rows = chained.select(F.explode(both).alias("d")).select("d.*")
    rows = rows.unionByName(placed.where("hadith_id IS NULL").select(*facts, _decide_alone(F.col("cands")).alias("d")).select(*facts, "d.best", "d.pool"))

    people = bios.withColumn("norm_name", F.coalesce(F.nullif("name_ar_normalized", F.lit("")), text.normalize_arabic(F.col("name_ar")), F.lit("")))
    people = people.withColumn("canonical_id", ids.canonical_id(F.when(F.col("norm_name") != "", F.col("norm_name")).otherwise(F.coalesce("name_en", F.lit("")))))
    accepted = rows.where("best IS NOT NULL").withColumn("cand", F.col("best.cand"))
    slim = accepted.select("cand", "ord", "mention_text")
    slim = (keep(slim) if keep else slim).join(people, "cand")
    log = accepted.join(people.select("cand", "canonical_id"), "cand").select("canonical_id", "mention_id", "mention_text", F.col("best.stage").alias("merge_stage"), F.col("best.score").cast("float").alias("score"))
    by_rank = people.select("cand", "canonical_id", F.coalesce("name_ar", "name_en", F.lit("")).alias("cand_name"))
    top = rows.where("best IS NULL").select("mention_id", "mention_text", "source_corpus", F.posexplode_outer(F.slice(F.array_sort(F.transform("pool", lambda c, i: F.struct((-c["score"]).alias("neg"), i.alias("i"), c["cand"].alias("cand"), c["score"].alias("score"), c["stage"].alias("stage")))), 1, 3)).alias("k", "c"))
    top = top.select("mention_id", "mention_text", "source_corpus", "k", F.col("c.cand").alias("cand"), F.col("c.score").alias("score"), F.col("c.stage").alias("stage")).join(by_rank, "cand", "left")
    fields = [
        F.max(F.when(F.col("k") == n, F.col(c))).cast("float" if c == "score" else "string").alias(f"candidate_{n + 1}_{alias}")
        for n in range(3)
        for c, alias in (("canonical_id", "id"), ("cand_name", "name"), ("score", "score"), ("stage", "stage"))
    ]
    ambiguous = top.groupBy("mention_id", "mention_text", "source_corpus").agg(*fields)
    return canonical_people(slim), ambiguous, log


def canonical_people(accepted: DataFrame) -> DataFrame:
    """One record per person: facts of the first match, all biographies in order, and names of later mentions that differ.

    Mentions with the same biography and text are first counted as one, with where they come first and where first after the
    person's first mention, so that what is shuffled and collected follows the distinct names."""
    start = accepted.groupBy("canonical_id").agg(F.min("ord").alias("start"))
    columns = ["canonical_id", "bio_id", "mention_text", "norm_name", "name_ar", "name_en", "birth_year_ah", "death_year_ah", "generation", "gender", "trustworthiness", "external_id"]
    each = accepted.join(start, "canonical_id").groupBy(*columns).agg(F.min("ord").alias("ord"), F.min(F.when(F.col("ord") > F.col("start"), F.col("ord"))).alias("later"), F.count("*").alias("n"))
    first = F.struct("name_ar", "name_en", F.col("norm_name").alias("name_ar_normalized"), "birth_year_ah", "death_year_ah", "generation", "gender", "trustworthiness", "external_id")
    alias = F.when(F.col("later").isNotNull() & (F.col("mention_text") != "") & (F.col("mention_text") != F.col("norm_name")), F.struct(F.col("later").alias("ord"), F.col("mention_text").alias("x")))
    values = lambda c: F.array_distinct(F.transform(F.array_sort(F.collect_list(c)), lambda s: s["x"]))
    out = each.groupBy("canonical_id").agg(
        F.min_by(first, "ord").alias("f"), values(alias).alias("aliases"), values(F.struct("ord", F.col("bio_id").alias("x"))).alias("source_ids"), F.sum("n").cast("int").alias("mention_count")
    )
    return out.select("canonical_id", "f.name_ar", "f.name_en", "f.name_ar_normalized", "aliases", "f.birth_year_ah", "f.death_year_ah", "f.generation", "f.gender", "f.trustworthiness", "source_ids", "f.external_id", "mention_count")


def write_back(mentions: DataFrame, log: DataFrame) -> DataFrame:
    """Mentions with the person and confidence of their accepted match."""
    accepted = log.select("mention_id", F.col("canonical_id").alias("__id"), F.col("score").alias("__score"))
    joined = mentions.drop("canonical_narrator_id", "confidence").join(accepted, "mention_id", "left")
    return joined.withColumnsRenamed({"__id": "canonical_narrator_id", "__score": "confidence"})
