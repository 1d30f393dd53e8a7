from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.operators import analytics, chains, graph, matching, parallels, quality
from strandline.plans.lineage import cut, stored
from strandline.sources import schemas

HADITHS = [
    ("sunnah:bukhari:1:1", "bukhari", None, None),
    ("sunnah:bukhari:2:7", "bukhari", "Narrated by Umar ibn al-Khattab from Abu Hurairah from the Prophet", "sahih"),
    ("sunnah:muslim:3:12", "muslim", "Narrated by Aisha from Abdullah ibn Umar from the Prophet", "sahih"),
]


@pytest.fixture(scope="module")
def staged(spark):
    rows = spark.createDataFrame(HADITHS, "source_id string, collection_name string, isnad_raw_en string, grade string")
    return schemas.conform(rows.withColumn("source_corpus", F.lit("sunnah")).withColumn("sect", F.lit("sunni")), "hadiths")


def counts(df):
    return {r["label"]: r["count"] for r in df.groupBy("label").count().collect()}


def test_fan_out_gives_the_published_end_state(staged):
    nodes, edges = graph.fan_out(staged)
    assert counts(nodes) == {"Hadith": 3, "Collection": 2, "Narrator": 5, "Chain": 3, "Grading": 2}
    assert counts(edges) == {"APPEARS_IN": 3, "TRANSMITTED_TO": 4, "NARRATED": 2, "GRADED_BY": 2}
    assert graph.require_endpoints(edges, nodes).count() == 11


def test_english_positions_keep_gaps(spark):
    rows = spark.createDataFrame([("Narrated from A from , from B.",), ("  ",), (None,)], "t string")
    got = [[(s["name"], s["position"], s["method"]) for s in r[0]] for r in rows.select(chains.spans(F.col("t"), "en")).collect()]
    assert got == [[("A", 2, None), ("B", 4, None)], [], []]


def test_arabic_spans(spark):
    rows = spark.createDataFrame([("حدثنا محمد عن  عن علي",), ("محمد بن علي",), ("زيد قال كتب إلي عمر",)], "t string")
    got = [[(s["name"], s["position"], s["method"]) for s in r[0]] for r in rows.select(chains.spans(F.col("t"), "ar")).collect()]
    assert got == [
        [("محمد", 0, "haddathana"), ("علي", 1, "an")],
        [("محمد بن علي", 0, None)],
        [("زيد", 0, None), ("عمر", 1, "kataba_ilayya")],
    ]


def test_pairs_skip_members_without_identity(spark):
    rows = spark.createDataFrame([("h", 0, "nar:1"), ("h", 1, None), ("h", 2, "nar:3")], "h string, pos int, id string")
    assert [tuple(r) for r in chains.pairs(rows, "h", ("pos",), "id").collect()] == [("h", "nar:1", "nar:3", 0)]
    assert chains.ordered_ids(rows, "h", ("pos",), "id").first()["member_ids"] == ["nar:1", "nar:3"]
    assert chains.first_member(rows, "h", ("pos",), "id").first()["first_id"] == "nar:1"


BIO = "cand long, bio_id string, name_ar string, name_en string, name_ar_normalized string, birth_year_ah int, death_year_ah int, generation string, gender string, trustworthiness string, external_id string"


def resolve(spark, mentions, bios):
    rows = [(f"m{k}", h, "lk", p, n, n, k) for k, (h, p, n) in enumerate(mentions)]
    m = spark.createDataFrame(rows, "mention_id string, hadith_id string, source_corpus string, position_in_chain int, name_raw string, name_normalized string, ord int")
    b = spark.createDataFrame([(k, f"bio-{k}", n, None, n, None, d, None, None, None, e) for k, (n, d, e) in enumerate(bios)], BIO)
    canonical, ambiguous, log = matching.resolve(m, b)
    return canonical, ambiguous, {r["mention_id"]: (r["merge_stage"], round(r["score"], 4), r["canonical_id"]) for r in log.collect()}


def test_stages_and_temporal_order(spark):
    bios = [("abdullah ibn umar", 59, None), ("abdullah ibn amar", 60, None), ("abdullah ibn omar", 93, None), ("zayd ibn thabit al-ansari", 45, "ms-1")]
    mentions = [("h1", 0, "abdullah ibn umar"), ("h1", 1, "abdullah ibn imar"), ("h2", 0, "abdullah ibn imar"), ("h3", 0, "zayd ibn thabit"), ("h3", 1, "unknown person")]
    canonical, ambiguous, log = resolve(spark, mentions, bios)
    assert log["m0"][:2] == ("exact", 1.0)
    ids_ = {n: r for n, r in [(r["name_ar"], r["canonical_id"]) for r in canonical.collect()]}
    assert log["m1"][2] == ids_["abdullah ibn omar"]  # candidates with deaths in 59 and 60 lie too near the neighbour's 59
    assert log["m2"][2] == ids_["abdullah ibn umar"]  # no neighbour: the first of equal scores
    assert log["m3"][0] == "crossref"
    assert [r["mention_id"] for r in ambiguous.collect()] == ["m4"]
    first = {r["name_ar"]: r for r in canonical.collect()}["abdullah ibn umar"]
    assert (first["mention_count"], first["aliases"], first["source_ids"]) == (2, ["abdullah ibn imar"], ["bio-0"])


def test_low_crossref_is_ambiguous(spark):
    _, ambiguous, log = resolve(spark, [("h", 0, "zaabcd")], [("zaabxyz", 10, "e")])
    row = ambiguous.first()
    assert log == {} and (row["candidate_1_stage"], round(row["candidate_1_score"], 4), row["candidate_2_id"]) == ("crossref", 0.6154, None)


def test_resolution_equals_brute_force(spark):
    """Every mention against every biography, chain by chain in order."""
    rng = np.random.default_rng(5)
    word = lambda n: "".join(rng.choice(list("abc"), n))
    bios = [(f"x{word(rng.integers(4, 8))}{k}", int(rng.integers(1, 200)) if rng.random() < 0.8 else None, "e" if rng.random() < 0.5 else None) for k in range(30)]

    def misspelt(name):
        letters = list(name)
        for _ in range(rng.integers(0, 4)):
            letters[rng.integers(2, len(letters))] = rng.choice(list("abcd"))
        return "".join(letters)

    mentions = [(f"h{c}", k, misspelt(bios[rng.integers(0, 30)][0])) for c in range(25) for k in range(rng.integers(1, 6))]

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            old, row = row, [i, *[0] * len(b)]
            for j, y in enumerate(b, 1):
                row[j] = min(old[j] + 1, row[j - 1] + 1, old[j - 1] + (x != y))
        return row[-1]

    def ratio(a, b):
        old = [0] * (len(b) + 1)
        for x in a:
            row = [0]
            for j, y in enumerate(b, 1):
                row.append(old[j - 1] + 1 if x == y else max(old[j], row[j - 1]))
            old = row
        return 200 * old[-1] / (len(a) + len(b))

    want, decided = {}, {}
    for m, (h, pos, name) in enumerate(mentions):
        near = [y for p in (pos - 1, pos + 1) if (y := decided.get((h, p))) is not None]
        close = [(-round(ratio(name, n) / 100, 4), k) for k, (n, _, _) in enumerate(bios) if n[:2] == name[:2] and distance(name, n) <= 2 and ratio(name, n) >= 80]
        fits = [c for c in close if bios[c[1]][1] is None or not near or any(15 <= abs(bios[c[1]][1] - y) <= 80 for y in near)]
        other = [(-round(ratio(name, n) / 100, 4), k) for k, (n, _, e) in enumerate(bios) if n[:2] == name[:2] and e and ratio(name, n) >= 60]
        exact = [(-1.0, k) for k, (n, _, _) in enumerate(bios) if n == name]
        stage, pool = next(((s, sorted(c)) for s, c in (("exact", exact), ("fuzzy", fits), ("crossref", other)) if c), ("", []))
        if pool and -pool[0][0] >= 0.7:
            want[f"m{m}"] = (stage, -pool[0][0], bios[pool[0][1]][0])
            decided[h, pos] = bios[pool[0][1]][1]
    canonical, _, log = resolve(spark, mentions, bios)
    names = {r["canonical_id"]: r["name_ar"] for r in canonical.collect()}
    assert {m: (stage, score, names[c]) for m, (stage, score, c) in log.items()} == {m: (s, round(x, 4), n) for m, (s, x, n) in want.items()}
    assert {s for s, _, _ in want.values()} == {"exact", "fuzzy", "crossref"}


def test_blocks_agree_with_all_pairs(spark):
    rng = np.random.default_rng(1)
    words = ["ab" + "".join(rng.choice(list("abc"), 5)) for _ in range(40)]
    names = spark.createDataFrame([(w,) for w in sorted(set(words))], "name string")
    bios = names.select(F.monotonically_increasing_id().alias("cand"), F.col("name").alias("name_ar_normalized"))
    key = lambda df: sorted(tuple(r) for r in df.select("name", "cand", "score").collect())
    assert key(matching.fuzzy_matches(names, bios)) == key(matching.unblocked_fuzzy(names, bios))


def test_write_back(spark):
    m = spark.createDataFrame([("a", None), ("b", None)], "mention_id string, canonical_narrator_id string").withColumn("confidence", F.lit(None).cast("float"))
    log = spark.createDataFrame([("nar:1", "a", "x", "exact", 1.0)], "canonical_id string, mention_id string, mention_text string, merge_stage string, score double")
    assert {r["mention_id"]: r["canonical_narrator_id"] for r in matching.write_back(m, log).collect()} == {"a": "nar:1", "b": None}


@pytest.mark.parametrize("block_rows", [16, 1000])
def test_neighbours_equal_brute_force(spark, block_rows):
    rng = np.random.default_rng(3)
    v = rng.standard_normal((70, 8))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    got = {(r["a"], r["b"]): r["score"] for r in parallels.neighbours(df, "id", "v", k=3, threshold=0.3, block_rows=block_rows).collect()}
    s = v @ v.T
    np.fill_diagonal(s, -9)
    want = {(min(i, j), max(i, j)) for i in range(70) for j in np.argsort(-s[i])[:3].tolist() if s[i, j] >= 0.3}
    assert set(got) == want


def test_lsh_candidates_hold_close_pairs(spark):
    v = np.random.default_rng(5).standard_normal((30, 16))
    v = np.vstack([v, v + 0.01])
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    got = {(r["a"], r["b"]) for r in parallels.candidates_by_planes(df, "id", "v").collect()}
    assert {(i, i + 30) for i in range(30)} <= got


def test_merges(spark):
    old = spark.createDataFrame([("x", 1, 2, 0)], "id string, a int, b int, ord int")
    new = spark.createDataFrame([("x", None, 3, 1), ("y", 5, None, 1)], "id string, a int, b int, ord int")
    coalesced = {r["id"]: (r["a"], r["b"]) for r in graph.merge_coalesce(old, new, ["id"], "ord").collect()}
    assert coalesced == {"x": (1, 3), "y": (5, None)}
    replaced = {r["id"]: (r["a"], r["b"]) for r in graph.merge_overwrite(old, new, ["id"], "ord").collect()}
    assert replaced == {"x": (None, 3), "y": (5, None)}
    assert graph.load_result(old, new, ["id"]) == graph.LoadResult(1, 1, 0)


def test_edges_need_their_nodes(spark):
    nodes = spark.createDataFrame([("Narrator", "a")], "label string, id string")
    edges = spark.createDataFrame([("NARRATED", "a", "Narrator", "zz", "Hadith", "{}")], "label string, src_id string, src_label string, dst_id string, dst_label string, props string")
    with pytest.raises(graph.MissingEndpoints, match="NARRATED: 1"):
        graph.require_endpoints(edges, nodes)


def test_props_are_allow_listed(spark):
    df = spark.createDataFrame([("Grading", "g", '{"grade":"x","evil":"y"}')], "label string, id string, props string")
    assert graph.shape_props(df, schemas.NODE_PROPS).first()["props"] == '{"grade":"x"}'
    with pytest.raises(ValueError, match="Other"):
        graph.shape_props(df.withColumn("label", F.lit("Other")), schemas.NODE_PROPS)


def test_cycles_and_validation(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4)], "src_id int, dst_id int")
    assert [(r["start"], r["length"]) for r in graph.cycles(edges).collect()] == [(1, 3), (2, 3), (3, 3)]
    assert graph.validate({"chain_integrity": graph.cycles(edges), "none": edges.limit(0)}) == {"chain_integrity": False, "none": True}


def test_measures_of_known_graphs(spark):
    nodes = spark.createDataFrame([(i,) for i in range(1, 6)], "id int")
    path = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (4, 5)], "src_id int, dst_id int")
    assert {r["id"]: r["betweenness"] for r in analytics.betweenness(nodes, path).collect()} == {1: 0, 2: 3, 3: 4, 4: 3, 5: 0}
    with pytest.raises(ValueError):
        analytics.betweenness(nodes, path, most_edges=3)
    ranks = {r["id"]: r["rank"] for r in analytics.pagerank(nodes, path, 10, keep=cut).collect()}
    assert ranks[5] > ranks[4] > ranks[1] == pytest.approx(0.15)
    two = spark.createDataFrame([(1, 2), (2, 3), (1, 3), (4, 5), (3, 4)], "src_id int, dst_id int")
    group = {r["id"]: r["community_id"] for r in analytics.communities(nodes, two, rounds=7, keep=cut).collect()}
    assert group[4] == group[5] and set(group) == {1, 2, 3, 4, 5}


def test_betweenness_equals_plain_counts(spark):
    """Shortest paths counted pair by pair, also over parts that don't meet, nodes without edges and ends that are no nodes."""
    rng = np.random.default_rng(2)
    pairs = {(int(a), int(b)) for a, b in rng.integers(0, 14, (50, 2)) if a != b} | {(20, 21), (21, 22), (22, 20), (21, 99)}
    ids = [*range(14), 20, 21, 22, 30]
    nodes, links = spark.createDataFrame([(i,) for i in ids], "id int"), spark.createDataFrame(sorted(pairs) * 2, "src_id int, dst_id int")
    every = sorted({*ids, 99})
    far = {(s, s): (0, 1) for s in every}
    for d in range(len(every)):
        for s in every:
            for v, w in pairs:
                if far.get((s, v), (None,))[0] == d and far.get((s, w), (d + 1,))[0] == d + 1:
                    far[s, w] = (d + 1, far.get((s, w), (0, 0))[1] + far[s, v][1])
    want = dict.fromkeys(ids, 0.0)
    for s in ids:
        for t in every:
            for v in ids:
                if v not in (s, t) and (s, t) in far and (s, v) in far and (v, t) in far and far[s, v][0] + far[v, t][0] == far[s, t][0]:
                    want[v] += far[s, v][1] * far[v, t][1] / far[s, t][1]
    assert {r["id"]: r["betweenness"] for r in analytics.betweenness(nodes, links).collect()} == pytest.approx(want)


def test_betweenness_of_parts_has_no_bound_on_edges(spark, monkeypatch):
    """Nothing is collected or broadcast, and edges are not refused unless a bound is given; levels are taken from both sides, parts sliced."""
    rng = np.random.default_rng(6)
    pairs = {(f"n{a:02}", f"n{b:02}") for a, b in rng.integers(0, 40, (400, 2)) if a != b} | {(f"p{k}", f"p{k + 1}") for k in range(6)}
    nodes = spark.createDataFrame([(x,) for x in sorted({x for p in pairs for x in p})], "id string")
    ids = [r["id"] for r in nodes.collect()]
    far = {s: {s: (0, 1)} for s in ids}
    for s in ids:
        for d in range(len(ids)):
            for v in [v for v, (e, _) in far[s].items() if e == d]:
                for w in (b for a, b in pairs if a == v):
                    if far[s].get(w, (d + 1,))[0] == d + 1:
                        far[s][w] = (d + 1, far[s].get(w, (0, 0))[1] + far[s][v][1])
    want = {v: sum(far[s][v][1] * far[v][t][1] / far[s][t][1] for s in ids for t in far[s] if v in far[s] and v not in (s, t) and t in far[v] and far[s][v][0] + far[v][t][0] == far[s][t][0]) for v in ids}
    context = type(spark.sparkContext)
    monkeypatch.setattr(context, "broadcast", lambda *_: pytest.fail("broadcast"))
    links = spark.createDataFrame(sorted(pairs), "src_id string, dst_id string")
    assert {r["id"]: r["betweenness"] for r in analytics.betweenness(nodes, links, keep=stored).collect()} == pytest.approx(want)


def test_overlaps(spark):
    people = spark.createDataFrame([(1, 10, 80), (2, 100, 170), (3, 0, 121), (4, None, 9)], "id int, birth_year int, death_year int")
    events = spark.createDataFrame([("e", 50, 60)], "event string, year_start int, year_end int")
    assert [r["id"] for r in analytics.overlaps(people, events).collect()] == [1]
    assert sorted(r["id"] for r in analytics.overlaps_bucketed(people.dropna(), events, "birth_year", "death_year", "year_start", "year_end").collect()) == [1, 3]


def test_topics(spark):
    df = spark.createDataFrame([("a", "prayer prayer war and more words"), ("b", "short")], "id string, t string")
    row = analytics.topics_lexical(df, "id", "t", {"war": ["war"], "ritual": ["prayer"], "food": ["bread"]}).collect()
    assert [(r["id"], r["topic_1"], round(r["topic_1_score"], 4)) for r in row] == [("a", "ritual", 0.6667)]
    scored = analytics.topics_scored(df, "id", "t", lambda: lambda texts: [[0.1, 0.9] + [0.0] * 12 for _ in texts])
    assert scored.first()["topic_1"] == "jurisprudence"


def test_topics_take_ascii_word_ends(spark):
    """As SQL's word boundary does: a letter beyond ASCII ends a word, an ASCII letter, digit or underscore doesn't."""
    df = spark.createDataFrame([("a", "and und and öder der\u00e4 \u00e9the, ders der_ 1the " + "x" * 20), ("b", "\u0635\u0644\u0627\u0629 \u0627\u0644\u0635\u0644\u0627\u0629 and " + "x" * 20)], "id string, t string")
    found = analytics.topics_lexical(df, "id", "t", {"one": ["the", "der"], "two": ["and"], "three": ["\u0635\u0644\u0627\u0629"]}).orderBy("id").collect()
    assert [(r["topic_1"], round(r["topic_1_score"], 4), r["topic_2"], round(r["topic_2_score"], 4)) for r in found] == [("one", 0.6, "two", 0.4), ("two", 0.5, "three", 0.5)]


def test_quality(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("a", None)], "id string, v int")
    assert {r["column_name"]: r["null_pct"] for r in quality.null_profile(df).collect()} == {"id": 33.33, "v": 33.33}
    assert quality.duplicate_ids(df, "id").first()["duplicates"] == 2
    base = spark.createDataFrame([("m", 100), ("z", 0)], "metric string, value int")
    now = spark.createDataFrame([("m", 131), ("z", 5)], "metric string, value int")
    assert {r["metric"]: (r["drift_pct"], r["ok"]) for r in quality.drift(now, base).collect()} == {"m": (31.0, False), "z": (100.0, False)}
    assert quality.verdict(["PASS", "WARN"], drift_ok=False) and not quality.verdict(["PASS"], drift_ok=False, strict=True)
    empty = schemas.conform(df.limit(0), "merge_log")
    assert quality.report(empty, "merge_log", "mention_id")["row_count"] == "FAIL"


def test_schema_problems(spark):
    df = spark.createDataFrame([("c", "m", 1)], "canonical_id string, mention_id string, score int")
    problems = quality.schema_problems(df, "merge_log")
    assert problems == {"missing": ["mention_text", "merge_stage"], "extra": [], "types": ["score"]}


def test_lag(spark):
    ends = spark.createDataFrame([("s", 0, 10), ("s", 1, 5)], "stage string, partition int, offset int")
    done = spark.createDataFrame([("s", 0, 4), ("s", 1, -1)], "stage string, partition int, offset int")
    assert {r["stage"]: r["lag"] for r in analytics.lag(ends, done).collect()} == {"s": 11, None: 11}


def test_communities_run_until_no_node_gains(spark):
    rng = np.random.default_rng(7)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 30, (160, 2)) if a != b]
    nodes = spark.createDataFrame([(i,) for i in range(31)], "id int")
    found = {r["id"]: r["community_id"] for r in analytics.communities(nodes, spark.createDataFrame(pairs, "src_id int, dst_id int"), keep=stored, levels=1).collect()}
    weights = np.zeros((31, 31))
    for a, b in pairs:
        weights[a, b] += 1
        weights[b, a] += 1
    strength, total = weights.sum(1), weights.sum()
    for i in range(31):
        gain = lambda c: sum(weights[i, j] - strength[i] * strength[j] / total for j in range(31) if j != i and found[j] == c)  # noqa: B023, E731
        assert all(gain(found[j]) <= gain(found[i]) + 1e-6 for j in range(31) if weights[i, j] > 0)
    assert sorted(found) == list(range(31))


def test_communities_join_over_levels(spark):
    """A ring of cliques: joining whole communities gives at least the modularity of the first level."""
    size, count = 4, 12
    pairs = [(size * c + i, size * c + j) for c in range(count) for i in range(size) for j in range(i)] + [(size * c, size * ((c + 1) % count) + 1) for c in range(count)]
    nodes, links = spark.createDataFrame([(i,) for i in range(size * count)], "id int"), spark.createDataFrame(pairs, "src_id int, dst_id int")

    def modularity(found):
        degree = {i: sum(i in p for p in pairs) for i in found}
        total = 2 * len(pairs)
        inside = sum(2 for a, b in pairs if found[a] == found[b]) / total
        return inside - sum((sum(d for i, d in degree.items() if found[i] == c) / total) ** 2 for c in set(found.values()))

    one, full = ({r["id"]: r["community_id"] for r in analytics.communities(nodes, links, keep=stored, levels=n).collect()} for n in (1, None))
    assert modularity(full) >= modularity(one) - 1e-9 and modularity(full) > 0.7
    assert all(len({full[size * c + i] for i in range(size)}) == 1 for c in range(count))
    assert all(c == min(i for i in full if full[i] == c) for c in set(full.values()))


def test_communities_of_a_dense_graph_take_few_rounds(spark):
    """Nodes of a block move one after the other in a task, so that a graph without structure doesn't take a round for each move."""
    rng, stages_ = np.random.default_rng(3), []
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 60, (700, 2)) if a != b]
    nodes, links = spark.createDataFrame([(i,) for i in range(60)], "id int"), spark.createDataFrame(pairs, "src_id int, dst_id int")
    found = analytics.communities(nodes, links, keep=lambda df, r: stages_.append(r) or stored(df), levels=1)
    assert found.count() == 60 and len(stages_) <= 12


def test_communities_in_blocks_end_where_no_node_gains(spark):
    rng = np.random.default_rng(11)
    pairs = [(f"n{a}", f"n{b}") for a, b in rng.integers(0, 24, (90, 2)) if a != b]
    nodes, links = spark.createDataFrame([(f"n{i}",) for i in range(25)], "id string"), spark.createDataFrame(pairs, "src_id string, dst_id string")
    runs = [{r["id"]: r["community_id"] for r in analytics.communities(nodes.repartition(n), links.repartition(n), keep=stored, levels=1, size=60).collect()} for n in (1, 3)]
    found, names = runs[0], sorted(runs[0])
    weights = np.zeros((25, 25))
    for a, b in pairs:
        weights[names.index(a), names.index(b)] += 1
        weights[names.index(b), names.index(a)] += 1
    strength, total = weights.sum(1), weights.sum()
    for i in range(25):
        gain = lambda c: sum(weights[i, j] - strength[i] * strength[j] / total for j in range(25) if j != i and found[names[j]] == c)  # noqa: B023, E731
        assert all(gain(found[names[j]]) <= gain(found[names[i]]) + 1e-6 for j in range(25) if weights[i, j] > 0)
    assert runs[0] == runs[1] and len(found) == 25


def test_communities_of_a_connected_graph_of_many_blocks_take_few_rounds(spark):
    """One part is one task's for all levels, however many blocks it would make; blocks are for parts beyond that, and end as well where no node gains."""
    rng, stages_ = np.random.default_rng(5), []
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 40, (300, 2)) if a != b] + [(50, 51), (51, 52)]
    ids = [*range(40), 50, 51, 52, 60]
    nodes, links = spark.createDataFrame([(i,) for i in ids], "id int"), spark.createDataFrame(pairs, "src_id int, dst_id int")
    found = analytics.communities(nodes, links, keep=lambda df, r: stages_.append(r) or stored(df), size=60)
    full = {r["id"]: r["community_id"] for r in found.collect()}
    assert len(stages_) <= 8 and sorted(full) == ids and all(c == min(i for i in ids if full[i] == c) for c in set(full.values()))
    assert [full[i] for i in (50, 51, 52, 60)] == [50, 50, 50, 60]
    for whole in (0, 1000):
        one = {r["id"]: r["community_id"] for r in analytics.communities(nodes, links, keep=stored, levels=1, size=300, whole=whole).collect()}
        weights = {i: {j: 0 for j in ids} for i in ids}
        for a, b in pairs:
            weights[a][b] += 1
            weights[b][a] += 1
        strength = {i: sum(weights[i].values()) for i in ids}
        for i in ids:
            gain = lambda c: sum(weights[i][j] - strength[i] * strength[j] / (2 * len(pairs)) for j in ids if j != i and one[j] == c)  # noqa: B023, E731
            assert all(gain(one[j]) <= gain(one[i]) + 1e-6 for j in ids if weights[i][j])


def test_parts_of_paths_and_stars(spark):
    rng = np.random.default_rng(8)
    names = rng.permutation(400).tolist()
    pairs = [*zip(names[:200], names[1:200], strict=False)] + [(names[300], x) for x in names[301:]] + [(names[250], names[250])]
    found = {r["id"]: r["part"] for r in analytics.parts(spark.createDataFrame([(f"n{a:03}", f"n{b:03}") for a, b in pairs], "src_id string, dst_id string").repartition(7), keep=stored).collect()}
    want = {f"n{x:03}": f"n{min(group):03}" for group in (names[:200], names[300:], [names[250]]) for x in group}
    assert found == want


def test_resolution_deals_mentions_out_once(spark, tmp_path):
    """By their chains; a mention of no chain, or one whose id comes again, is decided once, and what is collected follows the names."""
    rows = [("m0", "h", 0, "amar", 0), ("m1", "h", 1, "amar", 1), ("m1", "h", 2, "amar", 2), ("m2", None, 0, "amar", 3), ("m3", None, 1, "none", 4)]
    m = spark.createDataFrame([(i, h, "lk", p, n, n, k) for i, h, p, n, k in rows], "mention_id string, hadith_id string, source_corpus string, position_in_chain int, name_raw string, name_normalized string, ord int")
    m.write.parquet(f"{tmp_path}/m")
    b = stored(spark.createDataFrame([(0, "bio-0", "amar", None, "amar", None, 59, None, None, None, None)], BIO))
    canonical, ambiguous, log = matching.resolve(spark.read.parquet(f"{tmp_path}/m"), b, keep=stored)
    assert [(r["name_ar"], r["mention_count"], r["aliases"], r["source_ids"]) for r in canonical.collect()] == [("amar", 4, [], ["bio-0"])]
    assert sorted(r["mention_id"] for r in log.collect()) == ["m0", "m1", "m1", "m2"]
    assert [r["mention_id"] for r in ambiguous.collect()] == ["m3"]
    assert log._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange hashpartitioning") <= 1


def test_aliases_are_of_later_mentions_in_their_order(spark):
    rows = [("p", o, t, b) for o, t, b in [(1, "x", "b1"), (2, "z", "b2"), (3, "n", "b1"), (4, "x", "b1"), (5, "y", "b1"), (6, "z", "b1"), (7, "", "b1")]] + [("q", 1, "only", "b3")]
    df = spark.createDataFrame(rows, "canonical_id string, ord int, mention_text string, bio_id string")
    none = ["name_en", "generation", "gender", "trustworthiness", "external_id", "birth_year_ah", "death_year_ah"]
    df = df.select("*", F.lit("n").alias("norm_name"), F.concat(F.lit("name "), "bio_id").alias("name_ar"), *(F.lit(None).cast("string").alias(c) for c in none))
    found = {r["canonical_id"]: (r["name_ar"], r["aliases"], r["source_ids"], r["mention_count"]) for r in matching.canonical_people(df).collect()}
    assert found == {"p": ("name b1", ["z", "x", "y"], ["b1", "b2"], 7), "q": ("name b3", [], ["b3"], 1)}
