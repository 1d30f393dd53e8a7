"""The vector index, the graph's store, components, deletion neighbourhoods, keyed state and embeddings."""

from __future__ import annotations

import glob
import itertools
import json
import random
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.operators import chains, embedding, graph, graph_store, matching, parallels, partners, validation, vector_index
from strandline.plans.lineage import stored
from strandline.streaming import once, stages


def clustered(n, dims=24, groups=12, spread=0.5, seed=1):
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((groups, dims))
    v = centers[rng.integers(0, groups, n)] + spread * rng.standard_normal((n, dims))
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def plain_best(v, k, threshold):
    product = v @ v.T
    np.fill_diagonal(product, -np.inf)
    return {(i, int(j)) for i in range(len(v)) for j in np.argsort(-product[i], kind="stable")[:k] if product[i, j] >= threshold}


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    v = clustered(1200)
    rows = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)] + [(5000, None)], "id long, v array<double>").withColumn("cell", F.lit("x"))
    path = str(tmp_path_factory.mktemp("index"))
    vector_index.build(rows, "id", "v", f"{path}/i", stored, block_rows=64)
    return v, rows, f"{path}/i"


def test_index_is_read_back_and_exact_without_probes(spark, index):
    v, rows, path = index
    read = vector_index.load(spark, path)
    assert read.vectors.count() == 1200 and 20 < read.cells.count() <= 35 and read.cells.agg(F.sum("n")).first()[0] == 1200
    sizes = {(r["cell"], r["part"]): r["count"] for r in read.vectors.groupBy("cell", "part").count().collect()}
    assert max(sizes.values()) < 120 and max(p for _, p in sizes) > 0  # large cells are in parts
    found = vector_index.search(read, rows, "id", "v", stored, k=5, threshold=0.6, block_rows=64)
    assert {(r["id"], r["partner"]) for r in found.collect()} == plain_best(v, 5, 0.6)
    exact = parallels.neighbours(rows.where("v IS NOT NULL"), "id", "v", k=5, threshold=0.6)
    assert {(r["a"], r["b"]) for r in vector_index.pairs(found).collect()} == {(r["a"], r["b"]) for r in exact.collect()}


def test_few_probes_find_nine_in_ten(spark, index):
    v, rows, path = index
    read = vector_index.load(spark, path)
    found = {(r["id"], r["partner"]) for r in vector_index.search(read, rows, "id", "v", stored, k=10, probes=10).collect()}
    want = plain_best(v, 10, -2)
    assert len(found & want) >= 0.9 * len(want) and read.cells.count() >= 2 * 10


def test_groups_are_bounded_and_keep_the_best_only(spark, index, monkeypatch):
    """A query that wants every cell goes to each shelf once, and no more than its best leave a group."""
    v, rows, path = index
    monkeypatch.setattr(partners, "SHELF_NUMBERS", 24 * 200)
    sizes, meet = [], partners.meet

    def counted(asked, held, by, groups, work):
        each = meet(asked, held, by, groups, work)
        sizes.append((asked.count(), held.groupBy(*by).count().agg(F.max("count")).first()[0], each.count()))
        return each

    monkeypatch.setattr(partners, "meet", counted)
    found = vector_index.search(vector_index.load(spark, path), rows, "id", "v", stored, k=5, threshold=-1.0, block_rows=100)
    assert {(r["id"], r["partner"]) for r in found.collect()} == plain_best(v, 5, -1.0)
    exact = partners.within(rows.where("v IS NOT NULL").select("id", "v", F.lit(0).alias("of")), 5, -1.0, part_rows=100)
    assert {(r["id"], r["partner"]) for r in exact.collect()} == plain_best(v, 5, -1.0)
    for asked, largest, left in sizes:
        assert asked <= 1200 * 7 and largest <= 2 * 200 and left <= 5 * asked


def test_partners_of_copies_come_by_id_and_null_vectors_last(spark):
    """Equal vectors have equal scores wherever they stand in a group, so ids decide; a group with a label of its own."""
    v = np.random.default_rng(4).standard_normal((3, 7))
    rows = [(k, v[k % 3].tolist(), k % 2) for k in range(300)] + [(k, None, 2) for k in (900, 901, 902)] + [(903, v[0].tolist(), 2), (904, v[0].tolist(), None)]
    found = {}
    for r in partners.within(spark.createDataFrame(rows, "id long, v array<double>, of int"), 2).orderBy("id", "rank").collect():
        found.setdefault(r["id"], []).append(r["partner"])
    score = lambda a, b: -np.inf if rows[a][1] is None or rows[b][1] is None else sum(x * y for x, y in zip(rows[a][1], rows[b][1]))
    for a, (k, _, of) in enumerate(rows):
        others = sorted((b for b in range(len(rows)) if b != a and rows[b][2] == of and of is not None), key=lambda b: (-score(a, b), rows[b][0]))
        assert found.get(k, []) == [rows[b][0] for b in others[:2]]


def test_index_of_nothing_and_of_one(spark, tmp_path):
    none = spark.createDataFrame([], "id long, v array<double>")
    for n, rows in enumerate((none, spark.createDataFrame([(7, [1.0, 0.0])], none.schema), spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0])], none.schema))):
        read = vector_index.build(rows, "id", "v", f"{tmp_path}/{n}", stored)
        assert read.vectors.count() == rows.count()
        assert vector_index.search(read, rows, "id", "v", stored, k=3).select("id").distinct().count() == (2 if n == 2 else 0)


def test_no_number_of_a_projected_word_is_shuffled(spark):
    """The rows of a word's eight chunks are made after the last exchange."""
    rows = spark.createDataFrame([(1, "a b c"), (2, "b c d")], "id long, text string")
    plan = embedding.embed(rows, "id", "text")._jdf.queryExecution().executedPlan().toString()
    assert 0 <= plan.index("Generate inline(") < plan.index("Exchange ")


def test_rows_of_common_words_are_not_shuffled(spark, monkeypatch):
    """Vectors are the same however few words are common, also where a key comes again; texts are dealt once, and only rare words' rows go by word and back."""
    rows = spark.createDataFrame([(1, "a b c a"), (2, "b c d"), (1, "e A"), (3, "f"), (4, "?")], "id long, text string")
    vectors = []
    for common in (0, 2, 100):
        monkeypatch.setattr(embedding, "COMMON", common)
        found = embedding.embed(rows, "id", "text", keep=stored)
        vectors.append({r["id"]: r["v"] for r in found.collect()})
    assert set(vectors[0]) == {1, 2, 3} and vectors[0] == vectors[1] == vectors[2]  # to the last bit, as copies have to be
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    near = plan[: plan.index("Exchange hashpartitioning")]
    assert "inline(" in near and "BroadcastHashJoin [word" in near and "SortMergeJoin [word" not in near


def test_a_vector_is_sent_as_often_as_there_are_blocks(spark, monkeypatch):
    v, sent, meet = np.random.default_rng(12).standard_normal((400, 8)), [], partners.meet
    rows = spark.createDataFrame([(k, x.tolist(), 0) for k, x in enumerate(v)], "id long, v array<double>, of int")
    monkeypatch.setattr(partners, "SHELF_NUMBERS", 8 * 100)
    monkeypatch.setattr(partners, "meet", lambda asked, held, *rest: sent.append((asked.count(), held.count())) or meet(asked, held, *rest))
    found = partners.within(rows, 4, -100.0, part_rows=10)
    assert {(r["id"], r["partner"]) for r in found.collect()} == plain_best(v, 4, -100.0)
    assert all(a + b == 400 * 9 for a, b in sent)  # 8 blocks; one meets itself


ROWS = "kind string, label string, id string, src_id string, src_label string, dst_id string, dst_label string, props string, place struct<file: string, row: bigint>, k int"


def node(i, props, label="Narrator", file="a", row=0, k=0):
    return ("node", label, i, None, None, None, None, json.dumps(props), (file, row), k)


def edge(a, b, props, file="a", row=0, k=0):
    return ("edge", "TRANSMITTED_TO", None, a, "Narrator", b, "Narrator", json.dumps(props), (file, row), k)


def files(root):
    return set(glob.glob(f"{root}/graph/nodes/**/*.parquet", recursive=True))


def test_a_small_batch_leaves_most_of_the_graph(spark, tmp_path):
    layout = stages.Layout(str(tmp_path))
    work, store = stages.ingest(layout, buckets=16), stages.graph_of(layout, 16)
    many = [node(f"n{k}", {"name_en": f"x{k}"}, row=k) for k in range(200)] + [edge(f"n{k}", f"n{k + 1}", {"position_in_chain": k}, row=k) for k in range(199)]
    work(spark.createDataFrame(many, ROWS), "t", "s")
    before, reader = files(tmp_path), store.read(spark, "nodes")
    work(spark.createDataFrame([node("n3", {"name_ar": "y"}), node("new", {"name_en": "z"}), edge("new", "n3", {"position_in_chain": 1})], ROWS), "t", "s")
    after = files(tmp_path)
    assert len(after - before) <= 2 and len(before) >= 15
    nodes, edges = store.read(spark, "nodes"), store.read(spark, "edges")
    assert nodes.count() == 201 and edges.count() == 200
    assert json.loads(nodes.where("id = 'n3'").first()["props"]) == {"name_en": "x3", "name_ar": "y"}
    assert reader.count() == 200  # the snapshot that was being read is still there
    assert store.read(spark, "nodes", version=1).count() == 200 and store.versions(spark) == [1, 2]
    for k in range(3):
        work(spark.createDataFrame([node("n3", {"name_ar": str(k)})], ROWS), "t", "s")
    assert store.versions(spark) == [4, 5] and store.read(spark, "nodes").count() == 201
    old = spark.createDataFrame([("Narrator", "n3", json.dumps({"name_en": "x3", "name_ar": "y"}), (2, "a", 0, 0))], stages.GRAPH["nodes"].schema)
    new = spark.createDataFrame([("Narrator", "n3", json.dumps({"name_ar": "2"}), (5, "a", 0, 0))], stages.GRAPH["nodes"].schema)
    assert store.read(spark, "nodes").where("id = 'n3'").first()["props"] == stages.merge_props(old, new, ("label", "id")).first()["props"]


def generated(plan):
    """Rows that the Generate operators of a plan that has run gave out."""
    own = plan.metrics().apply("numOutputRows").value() if plan.nodeName() == "Generate" else 0
    return own + sum(generated(plan.children().apply(k)) for k in range(plan.children().size()))


def test_only_rows_whose_keys_come_again_are_taken_apart(spark):
    """stream_fanout: nearly all nodes of a batch are new, and each was shuffled property by property."""
    schema = stages.GRAPH["nodes"].schema
    old = spark.createDataFrame([("Hadith", "a", '{"sect":"x","grade":"g"}', (1, "f", 0, 0))], schema)
    rows = [("Hadith", f"n{k}", '{"sect":"y","grade":"g","matn_en":null}', (2, "f", k, 0)) for k in range(300)]
    rows += [("Hadith", "a", '{"sect":null,"grade":"h"}', (2, "f", 500, 0)), ("Hadith", "bare", "{}", (2, "f", 501, 0)), ("Hadith", "none", None, (2, "f", 502, 0)), ("Hadith", None, '{"sect":"p"}', (2, "f", 503, 0)), ("Hadith", None, '{"grade":"q"}', (2, "f", 504, 0))]
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        merged = stages.merge_props(old, spark.createDataFrame(rows, schema), ("label", "id"))
        found = {r["id"]: (r["props"], tuple(r["ord"])) for r in merged.collect()}
        assert generated(merged._jdf.queryExecution().executedPlan()) <= 8
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert len(found) == 304 and found["n7"] == ('{"grade":"g","sect":"y"}', (2, "f", 7, 0))
    assert found["a"] == ('{"grade":"h","sect":"x"}', (2, "f", 500, 0)) and found[None] == ('{"grade":"q","sect":"p"}', (2, "f", 504, 0))
    assert found["bare"] == ("{}", (2, "f", 501, 0)) and found["none"] == ("{}", (2, "f", 502, 0))


def test_edges_are_not_joined_again_once_no_endpoint_is_missing(spark):
    known = spark.createDataFrame([("Narrator", "a"), ("Narrator", "b")], "label string, id string")
    links = spark.createDataFrame([("TRANSMITTED_TO", "Narrator", "a", "Narrator", "b")], "label string, src_label string, src_id string, dst_label string, dst_id string")
    good = graph.require_endpoints(links, known)
    assert good.count() == 1 and "Join" not in good._jdf.queryExecution().executedPlan().toString()


def test_of_two_writers_one_fails_and_nothing_of_a_failed_batch_is_seen(spark, tmp_path):
    store = graph_store.Store(str(tmp_path), {"t": graph_store.Table("k string, n long", ("k",))}, buckets=4)
    last = lambda old, new, keys: old.union(new).groupBy(*keys).agg(F.max("n").alias("n"))
    rows = lambda *x: spark.createDataFrame(x, "k string, n long")
    assert store.merge(spark, {"t": rows(("a", 1), ("b", 1))}, last) == 1
    mine, theirs = store.write(spark, "t", rows(("a", 2)), last, 2), store.write(spark, "t", rows(("b", 3)), last, 2)
    store.commit(spark, 2, {"t": theirs})
    with pytest.raises(graph_store.Conflict):
        store.commit(spark, 2, {"t": mine})
    one = store.touched(rows(("a", 0)), "k") == store.touched(rows(("b", 0)), "k")
    assert one or sorted(map(tuple, store.read(spark, "t").collect())) == [("a", 1), ("b", 3)]
    layout = stages.Layout(f"{tmp_path}/l")
    with pytest.raises(graph.MissingEndpoints):
        stages.ingest(layout)(spark.createDataFrame([node("a", {}), edge("a", "nowhere", {})], ROWS), "t", "s")
    assert stages.graph_of(layout).versions(spark) == [] and stages.current_graph(spark, layout)[0].count() == 0


def test_last_props_by_place_over_several_files(spark, tmp_path):
    """Rows of later files, later rows and later numbers in a row win, however Spark reads the files."""
    layout = stages.Layout(str(tmp_path))
    hadiths = [(f"sunnah:b:{k:03}", "sunnah", "b", "sunni", "Umar from A from B from A from B", "x" * (20_000 if k < 10 else 10)) for k in range(40)]
    schema = "source_id string, source_corpus string, collection_name string, sect string, isnad_raw_en string, matn_en string"
    for k in range(0, 40, 10):
        spark.createDataFrame(hadiths[k : k + 10], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/raw/b1")
    names = sorted(glob.glob(f"{tmp_path}/raw/b1/*.parquet"))
    last = spark.read.parquet(names[-1]).orderBy("source_id").collect()[-1]["source_id"]
    stages.publish(spark, layout, stages.TOPICS[0], "b1", "sunnah", f"{tmp_path}/raw/b1", 40)
    work = {"dedup": stages.dedup(), "enrich": stages.enrich(), "normalize": stages.normalize(), "ingest": stages.ingest(layout)}
    for name in stages.STAGES:
        assert stages.start(spark, layout, name, work[name]).awaitTermination(120)
    _, edges = stages.current_graph(spark, layout)
    props = [json.loads(r["props"]) for r in edges.where("label = 'TRANSMITTED_TO'").collect()]
    assert {p["hadith_id"] for p in props} == {f"hdt:{last}"} and sorted(str(p["position_in_chain"]) for p in props) == ["0", "2", "3"]


def plain_components(edges):
    nodes = {x for e in edges for x in e}
    reach = {n: {b for a, b in edges if a == n} for n in nodes}
    for mid, a in itertools.product(nodes, nodes):
        if mid in reach[a]:
            reach[a] |= reach[mid]
    return {n: min([m for m in nodes if m == n or m in reach[n] and n in reach[m]]) for n in nodes}


@pytest.mark.parametrize("seed", [1, 2])
def test_strong_components(spark, seed):
    rng = random.Random(seed)
    edges = {(rng.randrange(40), rng.randrange(40)) for _ in range(45)} | {(50, 50), (60, 61), (61, 62), (62, 60), (62, 70)}
    found = {r["id"]: (r["component"], r["size"]) for r in graph.strong_components(spark.createDataFrame(sorted(edges), "src_id int, dst_id int"), stored).collect()}
    want = plain_components(edges)
    assert {n: c for n, (c, _) in found.items()} == want and len(set(want.values())) < len(want)
    assert all(size == sum(c == x for x in want.values()) for c, size in found.values())


def test_a_large_graph_without_cycles_is_peeled(spark):
    """Twenty layers with all edges between neighbours have 30 ** 20 paths; none is grown."""
    edges = spark.createDataFrame([(30 * k + a, 30 * k + 30 + b) for k in range(19) for a in range(30) for b in range(30)], "src_id long, dst_id long")
    assert graph.within_components(edges, stored).isEmpty()
    assert graph.cycles(edges, keep=lambda df, _: stored(df)).isEmpty()
    with_cycle = edges.union(spark.createDataFrame([(1000, 1001), (1001, 1000), (599, 1000)], edges.schema))
    assert [(r["length"], r["start"]) for r in graph.cycles(with_cycle, keep=lambda df, _: stored(df)).collect()] == [(2, 1000), (2, 1001)]


def test_deletions_find_all_pairs_within_two_edits(spark):
    rng = random.Random(4)
    words = {"", "a", "ab", "ba", "abc", "é", "日本語", None} | {"".join(rng.choices("abc", k=rng.randint(0, 7))) for _ in range(120)}
    names = spark.createDataFrame([(w, k % 3) for k, w in enumerate(sorted(words, key=str))], "name string, k int")
    others = names.select(F.col("name").alias("other"), F.col("k").alias("j"))
    found = sorted((r["name"], r["other"]) for r in matching.within_deletions(names, others, "name", "other").collect())
    want = spark.createDataFrame([(a, b) for a in words for b in words if a is not None and b is not None], "a string, b string").where("levenshtein(a, b) <= 2")
    assert found == sorted(map(tuple, want.collect()))


def test_each_key_once_in_a_while(spark, tmp_path):
    """Over runs of the query: repeats are skipped within the time, later ones pass, and states that are over are cleared."""
    hour = lambda h: datetime(2024, 1, 1) + timedelta(hours=h)
    runs = [[("a", 0, 1), ("a", 1, 2), ("b", 1, 3), (None, 1, 4), ("a", 0, 0)], [("a", 9, 5), ("b", 12, 6), ("c", 12, 7)], [("a", 100, 8), ("c", 100, 9), ("c", 101, 10)]]
    sizes = []
    for rows in runs:
        df = spark.createDataFrame([(k, hour(h), n) for k, h, n in rows], "key string, ts timestamp, n int")
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        found = once.once(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"), "key", "ts", timedelta(hours=10), order=("n",))
        query = once.start(found, lambda out, i: out.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={i}"), f"{tmp_path}/progress")
        assert query.awaitTermination(120) and query.exception() is None
        sizes.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert sorted(r["n"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [0, 3, 6, 7, 8, 9]
    assert sizes[2] <= sizes[1]


@pytest.mark.parametrize("most", [1, 2, 3])
def test_deletions_find_all_kinds_of_edits_and_are_not_broadcast(spark, most):
    rng = random.Random(most)
    words = sorted({"".join(rng.choice("ab1") for _ in range(rng.randrange(0, 7))) for _ in range(120)} | {"", "a", "ab\0", "\U0001f600b", "b\U0001f600"})
    left, right = spark.createDataFrame([(w,) for w in words], "a string"), spark.createDataFrame([(w,) for w in words[::2]], "b string")
    found = matching.within_deletions(left, right, "a", "b", most).select("a", "b")
    want = left.crossJoin(right).where(F.levenshtein("a", "b") <= most)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "Generate" in plan and not any("Broadcast" in line for line in plan.splitlines() if plan.index(line) > plan.index("SortMergeJoin [key"))


@pytest.mark.parametrize("most", [1, 2])
def test_near_names_are_counted_where_they_are_met(spark, most):
    """Rows count, equal strings don't; no pair is met twice and none is shuffled: after the join, counts by name are."""
    rng = random.Random(most)
    words = ["".join(rng.choice("ab1") for _ in range(rng.randrange(0, 8))) for _ in range(150)] + ["", "ababab", "bababa", "\U0001f600b", "b\U0001f600"] + [f"n{k:06}" for k in range(130)]
    names = spark.createDataFrame([(w,) for w in words + [None]], "name string")
    found = matching.near_counts(names, "name", most)
    want = names.crossJoin(names.toDF("other")).where((F.col("name") != F.col("other")) & (F.levenshtein("name", "other") <= most)).groupBy("name").count()
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].split("SortMergeJoin")[0]
    assert plan.count("Exchange") == 1 and plan.index("HashAggregate") < plan.index("Exchange") < plan.rindex("HashAggregate")


def test_embeddings_are_unit_vectors_and_alike_for_copies(spark):
    rng = random.Random(9)
    base = [" ".join(rng.choices([f"w{k}" for k in range(300)], k=80)) for _ in range(12)]
    texts = base + [b.replace(" ", " extra, ", 1) for b in base] + ["", None, "..."]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string").withColumn("word", F.lit("x"))
    found = {r["id"]: np.array(r["v"]) for r in embedding.embed(rows, "id", "text").collect()}
    assert set(found) == set(range(24)) and all(abs(np.linalg.norm(v) - 1) < 1e-9 for v in found.values())
    alike = [found[k] @ found[k + 12] for k in range(12)]
    assert min(alike) > 0.9 > max(found[a] @ found[b] for a, b in itertools.combinations(range(12), 2)) + 0.2
    assert embedding.embed(rows.limit(0), "id", "text").count() == 0


def test_validation_reads_a_table_once(spark, tmp_path, capsys):
    from strandline import cli
    from strandline.sources import schemas

    rows = [("a:b:1", "lk", "b", "نص", "text", 1), ("a:b:1", "lk", "b", None, " \n", None), (None, "lk", "b", "latin", None, 2)]
    df = schemas.conform(spark.createDataFrame(rows, "source_id string, source_corpus string, collection_name string, matn_ar string, matn_en string, book_number int").withColumn("sect", F.lit("sunni")), "hadiths")
    df.write.parquet(f"{tmp_path}/s/hadiths_lk.parquet")
    read = spark.read.parquet(f"{tmp_path}/s/hadiths_lk.parquet")
    found = validation.validate(read, validation.table_of("hadiths_lk"), {"row_count": 2})
    assert {r["check"]: (r["status"], r["value"]) for r in found.collect()} == {
        "row_count": ("PASS", 3.0), "schema_conformance": ("PASS", 0.0), "null_check_source_id": ("FAIL", 33.33), "null_check_source_corpus": ("PASS", 0.0), "null_check_collection_name": ("PASS", 0.0), "null_check_sect": ("PASS", 0.0),
        "duplicate_ids": ("WARN", 1.0), "arabic_encoding_matn_ar": ("WARN", 50.0), "empty_matn_ar": ("PASS", 1.0), "empty_matn_en": ("WARN", 2.0), "book_coverage": ("PASS", 66.67), "chapter_coverage": ("PASS", 0.0), "drift_row_count": ("DRIFT", 50.0),
    }
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    nothing = {r["check"]: r["status"] for r in validation.validate(read.limit(0).drop("grade"), "hadiths").collect()}
    assert nothing["row_count"] == nothing["schema_conformance"] == "FAIL" and "duplicate_ids" not in nothing and "book_coverage" not in nothing
    (tmp_path / "base.json").write_text(json.dumps({"hadiths_lk": 3}))
    assert cli.main(["validate-staging", f"{tmp_path}/s", "--baseline", f"{tmp_path}/base.json", "--output-json", f"{tmp_path}/out.json"], spark) == 1
    written = json.loads((tmp_path / "out.json").read_text())
    assert not written["passed"] and len(written["files"]["hadiths_lk"]["checks"]) == 13


def test_mentions_of_all_corpora_in_their_order(spark):
    """Parsed mentions where there are some, else those cut from chains; corpora without either are left out."""
    hadith = "source_id string, source_corpus string, isnad_raw_en string, isnad_raw_ar string, full_text_en string, full_text_ar string"
    sunnah = spark.createDataFrame([("sunnah:b:1", "sunnah", "Umar from Zayd", None, None, None), ("sunnah:b:2", "sunnah", None, None, "Ali from Amr", None)], hadith)
    given = spark.createDataFrame([("sanadset:mention:s:0", "s", "sanadset", 0, "x", None, "x", None)], "mention_id string, source_hadith_id string, source_corpus string, position_in_chain int, name_ar string, name_en string, name_ar_normalized string, transmission_method string")
    found = chains.consolidate({"sunnah": sunnah}, {"sanadset": given}).orderBy("src_ord", "hadith_id", "position_in_chain").collect()
    assert [(r["hadith_id"], r["source_corpus"], r["position_in_chain"], r["name_raw"]) for r in found] == [
        ("s", "sanadset", 0, "x"), ("sunnah:b:1", "sunnah", 0, "Umar"), ("sunnah:b:1", "sunnah", 1, "Zayd"), ("sunnah:b:2", "sunnah", 0, "Ali"), ("sunnah:b:2", "sunnah", 1, "Amr"),
    ]
    assert {r["canonical_narrator_id"] for r in found} == {None} and found[0]["src_ord"] < found[1]["src_ord"]


class _State:
    """A value and timers that count the calls, each of which goes through a socket to Spark."""

    def __init__(self):
        self.value, self.timers, self.calls = None, [], 0

    def __getattribute__(self, name):
        if name in ("exists", "get", "update", "listTimers", "deleteTimer", "registerTimer"):
            self.calls += 1
        return object.__getattribute__(self, name)

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def listTimers(self):  # noqa: N802
        return iter(self.timers)

    def deleteTimer(self, timer):  # noqa: N802
        self.timers.remove(timer)

    def registerTimer(self, timer):  # noqa: N802
        self.timers.append(timer)


@pytest.mark.parametrize("order", ["n", "s"])
def test_a_key_calls_its_state_no_more_than_needed(order):
    import pandas as pd

    worker = once.Once("ts", [order], 3_600_000_000)
    worker.handle = worker.last = state = _State()
    frame = lambda *rows: pd.DataFrame([(datetime(2024, 1, 1, h), n, f"s{n}") for h, n in rows], columns=["ts", "n", "s"])
    run = lambda *frames: [n for out in worker.handleInputRows(("k",), iter(frames), None) for n in out["n"]]
    assert run(frame((2, 3), (0, 2), (0, 1)), frame((0, 0))) == [0, 3] and state.calls <= 3 and len(state.timers) == 1
    assert run(frame((2, 4))) == [] and state.calls <= 4 and len(state.timers) == 1
    assert run(frame((3, 5))) == [5] and state.timers == [int(datetime(2024, 1, 1, 4).replace(tzinfo=timezone.utc).timestamp() * 1000)]
