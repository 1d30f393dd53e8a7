from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from strandline.operators import graph
from strandline.plans import catalog, pipeline
from strandline.sources import parsers, readers, schemas, sinks
from strandline.streaming import messages, stages


def write(folder, name, text, encoding="utf-8"):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_sanadset(spark, tmp_path):
    rows = 'hadith_id,book_id,hadith,grade\n1,2,"<SANAD><NAR>محمد</NAR> عن <NAR>علي</NAR></SANAD><MATN>متن</MATN>",sahih\n2,2,"<SANAD>No SANAD</SANAD><MATN>x</MATN>",nan\n'
    hadiths, mentions = parsers.sanadset(spark, write(tmp_path, "s.csv", rows))
    found = hadiths.orderBy("hadith_number").collect()
    assert [(r["source_id"], r["matn_ar"], r["isnad_raw_ar"], r["grade"]) for r in found] == [("sanadset:sanadset:2:1:0", "متن", "محمد عن علي", "sahih"), ("sanadset:sanadset:2:2:1", "x", None, None)]
    assert [(r["name_ar"], r["position_in_chain"], r["transmission_method"]) for r in mentions.orderBy("position_in_chain").collect()] == [("محمد", 0, None), ("علي", 1, "عن")]
    assert hadiths.schema.names == schemas.schema("hadiths").names


def test_editions(spark, tmp_path):
    for lang, items in (("eng", [(1, "one"), (2, "two")]), ("ara", [(2, "old"), (2, "اثنان"), (3, "ثلاثة")])):
        write(tmp_path, f"{lang}-bukhari.json", json.dumps({"metadata": {"name": "B"}, "hadiths": [{"hadithnumber": n, "text": t, "grades": []} for n, t in items]}))
    found = {r["hadith_number"]: (r["matn_en"], r["matn_ar"]) for r in parsers.fawaz(spark, str(tmp_path)).collect()}
    assert found == {1: ("one", None), 2: ("two", "اثنان"), 3: (None, "ثلاثة")}


def test_json_shapes(spark, tmp_path):
    item = {"hadithNumber": 1, "textAr": "ن", "textEn": "t", "grade": "g", "chapterNumber": 3}
    write(tmp_path, "book_4.json", json.dumps({"bookName": "Al-Kafi", "data": [item]}))
    write(tmp_path, "book_5.json", json.dumps([{"id": 9, "arabicText": "ع", "book": "Other"}]))
    found = sorted((r["source_id"], r["matn_ar"], r["matn_en"]) for r in parsers.thaqalayn(spark, f"{tmp_path}/*.json").collect())
    assert found == [("thaqalayn:al_kafi:4:1", "ن", "t"), ("thaqalayn:other:5:9", "ع", None)]


def test_api_and_scraped(spark, tmp_path):
    write(tmp_path / "a", "muslim_hadiths.json", json.dumps([{"hadithNumber": "7", "bookNumber": "1", "hadith": [{"lang": "en", "body": "e"}, {"lang": "ar", "body": "ع"}], "grades": [{"grade": "x"}, {"grade": "y"}]}]))
    row = parsers.sunnah_api(spark, str(tmp_path / "a")).first()
    assert (row["source_id"], row["matn_ar"], row["matn_en"], row["grade"]) == ("sunnah:muslim:1:7", "ع", "e", '["x","y"]')
    write(tmp_path / "b", "bukhari.json", json.dumps([{"hadith_number": "3", "book_number": "1", "chapter_number": "2", "text_en": "t", "grade": "sahih"}]))
    scraped = parsers.sunnah_scraped(spark, str(tmp_path / "b"))
    assert scraped.first()["source_id"] == "sunnah:bukhari:1:2:3"
    editions = schemas.conform(spark.createDataFrame([("fawaz:bukhari:3", "bukhari", 3)], "source_id string, collection_name string, hadith_number int"), "hadiths")
    assert parsers.enrich_metadata(editions, scraped).first()["chapter_number"] == 2


def test_network_and_biographies(spark, tmp_path):
    names = spark.createDataFrame([("N1", "A"), ("N2", "B")], "id string, name string")
    chains_ = spark.createDataFrame([("h1", "N1,N2"), ("h2", "N2, N3"), ("h3", "N1,N1,N2,N3")], "id string, narrator_ids string")
    found = parsers.muhaddithat_edges(names, chains_)
    assert found.count() == 4 and {r["to_narrator_name"] for r in found.collect()} == {"B", "N3"}
    bios = parsers.bios(spark, write(tmp_path, "n.csv", "ID,Name,Death,Grade,Kunyah\nN1,Aisha,58,thiqa,Umm\nN1,Again,1,,\nN2,,x,,\n"), "muhaddithat").orderBy("bio_id").collect()
    assert [(r["bio_id"], r["name_ar"], r["death_year_ah"], r["trustworthiness"], r["kunya"]) for r in bios] == [("muhaddithat:N1", "Aisha", 58, "thiqa", "Umm"), ("muhaddithat:N2", None, None, None, None)]


def test_collections_of_files_and_folders(spark, tmp_path):
    head = ",".join(parsers.LK_COLUMNS)
    row = "1,c,,,,,{n},,,text,,,,,sahih,"
    for n, name in enumerate(("albukhari.csv", "nesai/Chapter1.csv", "Nesai/Chapter2.csv", "ibnmaja/Chapter9.csv", "unknown/x.csv")):
        write(tmp_path, name, f"{head}\n{row.format(n=n)}\n")
    hadiths, _, collections = parsers.lk(spark, str(tmp_path))
    assert sorted(r["source_id"] for r in hadiths.collect()) == ["lk:bukhari:1:0", "lk:ibn_majah:1:3", "lk:nasai:1:1", "lk:nasai:1:2"]
    found = {r["collection_id"]: (r["name_en"], r["compiler_name"], r["compilation_year_ah"], r["total_hadiths"]) for r in collections.collect()}
    assert found.pop("lk:bukhari") == ("Sahih al-Bukhari", "Muhammad ibn Ismail al-Bukhari", 256, 1)
    assert found == {"lk:nasai": ("Sunan al-Nasa'i", "Ahmad ibn Shu'ayb al-Nasa'i", 303, 2), "lk:ibn_majah": ("Sunan Ibn Majah", "Ibn Majah al-Qazwini", 273, 1)}


def test_names_of_files_and_editions(spark, tmp_path):
    for name in ("Musnad_Ahmad-tashkeel.csv", "Sunan-with-diacritics.csv", "tashkeel.csv"):
        write(tmp_path / "open", name, "1,نص\n,ثان\n")
    found = parsers.open_hadith(spark, str(tmp_path / "open"))
    assert {(r["collection_name"], r["hadith_number"]) for r in found.collect()} == {(c, n) for c in ("Musnad_Ahmad", "Sunan", "tashkeel") for n in (1, 2)}
    write(tmp_path / "ed", "eng-first.json", json.dumps({"metadata": {"name": "Al-Kafi Vol 1"}, "hadiths": [{"hadithnumber": 1, "text": "t", "grades": []}]}))
    editions = parsers.fawaz(spark, str(tmp_path / "ed"))
    assert [(r["collection_name"], r["sect"]) for r in editions.collect()] == [("first", "shia")]
    named = parsers.collections(editions, parsers.fawaz_names(spark, str(tmp_path / "ed"))).first()
    assert (named["collection_id"], named["name_en"], named["total_hadiths"], named["sect"]) == ("fawaz:first", "Al-Kafi Vol 1", 1, "shia")
    write(tmp_path / "sc", "musnad.json", json.dumps([{"hadith_number": "3"}]))
    write(tmp_path / "sc", "manifest.json", json.dumps([{"hadith_number": "9"}]))
    scraped = parsers.sunnah_scraped(spark, str(tmp_path / "sc"))
    assert [(r["collection_name"], r["hadith_number"]) for r in scraped.collect()] == [("musnad", 3)]
    assert parsers.collections(scraped).first()["collection_id"] == "sunnah:musnad"


def test_pages_end_when_empty_or_at_the_total():
    pages = {1: {"data": [1, 2], "total": 3}, 2: {"data": [3], "total": 3}, 3: {"data": [4], "total": 3}}
    asked = []

    class Pages(readers._PagesReader):
        def _fetch(self, url):
            asked.append(url)
            return self.answers(int(url.split("page=")[1].split("&")[0]))

    reader = Pages({"url": "http://x/y", "limit": "2"})
    reader.answers = lambda k: pages[k]
    assert [i for _, i in reader.read(reader.partitions()[0])] == ["1", "2", "3"] and len(asked) == 2
    reader.answers = lambda k: {"data": [k] * 2 if k < 4 else []}
    assert len(list(reader.read(reader.partitions()[0]))) == 6
    turns = Pages({"url": "http://x/y?a=1", "readers": "2", "limit": "2"})
    turns.answers = lambda k: [k] if k < 6 else []
    assert sorted(i for part in turns.partitions() for _, i in turns.read(part)) == list("12345")


def test_encodings_and_bad_rows(spark, tmp_path):
    latin = write(tmp_path, "l.csv", "a,b\né,1\n", "latin-1")
    assert readers.csv_encoding(spark, latin) == "ISO-8859-1" and readers.csv(spark, latin).first()["a"] == "é"
    mixed = tmp_path / "mixed"
    write(mixed, "u.csv", "a,b\né,1\n")
    write(mixed, "l.csv", "a,b\nü,2\n", "latin-1")
    assert {(r["a"], r["b"], r["file"]["name"]) for r in readers.csv(spark, str(mixed), file=True).collect()} == {("é", "1", "u.csv"), ("ü", "2", "l.csv")}
    bad = write(tmp_path, "b.csv", "a,b\n1,2\n1,2,3\n")
    assert readers.good_rows(readers.csv(spark, bad, columns=["a", "b"]).cache()).count() == 1


def test_scrape_takes_the_first_selector_that_finds(spark):
    pages = spark.createDataFrame([("<div class='x'>one <b>two</b></div><p class=y>z</p>",), (None,)], "html string")
    assert [r["t"] for r in readers.scrape(pages, {"t": ["span.q", "div.x", "p.y"]}).collect()] == ["one two", None]


def test_batch_manifest_and_sample(spark, tmp_path):
    df = spark.range(300).withColumn("v", F.lit("x"))
    manifest = sinks.batch({"a": df, "b": df.limit(2)}, str(tmp_path), "b1", "src")
    assert {r["label"]: r["row_count"] for r in manifest.collect()} == {"a": 300, "b": 2}
    assert sinks.sample(df, ["id"]).collect() == sinks.sample(df.repartition(5), ["id"]).collect()


HADITH = "source_id string, source_corpus string, collection_name string, sect string, isnad_raw_en string, grade string, matn_en string"


def run(spark, layout, stage, work):
    query = stages.start(spark, layout, stage, work)
    assert query.awaitTermination(120)
    assert query.exception() is None


def test_stages_replay_and_dead_letters(spark, tmp_path):
    layout = stages.Layout(str(tmp_path))
    rows = [("sunnah:bukhari:2:7", "sunnah", "bukhari", "sunni", "Narrated by A from B", "sahih", "text"), (None, "sunnah", "x", "sunni", None, None, None)]
    spark.createDataFrame(rows, HADITH).write.parquet(f"{tmp_path}/raw/b1")
    stages.publish(spark, layout, stages.TOPICS[0], "b1", "sunnah", f"{tmp_path}/raw/b1", 2)
    stages.publish(spark, layout, stages.TOPICS[0], "b2", "sunnah", f"{tmp_path}/raw/missing", 1)
    spark.createDataFrame([('{"batch_id": "x", "oops": 1}',)], "value string").write.mode("append").text(layout.topic(stages.TOPICS[0]))
    work = {"dedup": stages.dedup(), "enrich": stages.enrich(), "normalize": stages.normalize(), "ingest": stages.ingest(layout)}
    for name in stages.STAGES:
        run(spark, layout, name, work[name])
    nodes, edges = stages.current_graph(spark, layout)
    assert {r["label"]: r["count"] for r in nodes.groupBy("label").count().collect()} == {"Hadith": 1, "Collection": 1, "Narrator": 2, "Chain": 1, "Grading": 1}
    assert edges.count() == 4
    letters = spark.read.parquet(layout.topic(stages.DEAD_LETTERS))
    assert {r["error_class"] for r in letters.collect()} == {"ValidationError", "AnalysisException"}
    measured = spark.read.parquet(layout.metrics)
    assert measured.where("errors = 1").count() == 1 and measured.where("errors = 0").count() == 4 and measured.where("duration_seconds <= 0").isEmpty()
    topics = spark.createDataFrame([("hdt:sunnah:bukhari:2:7", "law", 0.5, None)], "id string, topic_1 string, topic_1_score float, topic_2 string")
    written = graph.with_topics(nodes, topics)
    props = json.loads(written.where("label = 'Hadith'").first()["props"])
    assert (props["topic_1"], props["topic_1_score"], props["sect"]) == ("law", "0.5", "sunni") and "topic_2" not in props and written.count() == nodes.count()
    failed = json.loads(letters.where("error_class = 'AnalysisException'").first()["raw_payload"])
    assert failed["batch_id"] == "b2" and failed["b2_path"].endswith("raw/missing") and failed["record_count"] == 1
    stages.publish(spark, layout, stages.TOPICS[0], "b1", "sunnah", f"{tmp_path}/raw/b1", 2)
    before = spark.read.parquet(layout.checkpoints).count()
    run(spark, layout, "dedup", work["dedup"])
    assert spark.read.parquet(layout.checkpoints).count() == before


def test_ingest_keeps_the_last_value_that_is_not_null(spark, tmp_path):
    layout = stages.Layout(str(tmp_path))
    work = stages.ingest(layout)
    rows = "kind string, label string, id string, src_id string, src_label string, dst_id string, dst_label string, props string"
    node = lambda i, label, p: ("node", label, i, None, None, None, None, json.dumps(p))
    edge = lambda p: ("edge", "APPEARS_IN", None, "h", "Hadith", "c", "Collection", json.dumps(p))
    first = [node("h", "Hadith", {"grade": "a", "sect": "x"}), node("h", "Hadith", {"grade": "b"}), node("c", "Collection", {}), edge({"book_number": 1, "chapter_number": 5}), edge({"book_number": 2})]
    second = [node("h", "Hadith", {"grade": None, "sect": "y"}), edge({"chapter_number": None, "hadith_number_in_book": 9})]
    for batch in (first, second):
        work(spark.createDataFrame(batch, rows).coalesce(1), "t", "s")
    nodes, edges = stages.current_graph(spark, layout)
    assert json.loads(nodes.where("id = 'h'").first()["props"]) == {"grade": "b", "sect": "y"}
    assert {k: str(v) for k, v in json.loads(edges.first()["props"]).items()} == {"book_number": "2", "chapter_number": "5", "hadith_number_in_book": "9"} and edges.count() == 1


def test_messages(spark):
    good = {"batch_id": "b", "source": "s", "b2_path": "p", "timestamp": "2024-01-01T00:00:00Z", "record_count": 0}
    raw = [json.dumps(good), json.dumps(good | {"extra": 1}), json.dumps(good | {"record_count": -1}), "nonsense", json.dumps({k: v for k, v in good.items() if k != "source"})]
    ok, bad = messages.split(messages.parse(spark.createDataFrame([(r,) for r in raw], "value string")))
    assert ok.count() == 1 and bad.count() == 4


def test_plans(spark, tmp_path):
    steps = pipeline.run_steps({"a": lambda: 1, "b": lambda: 1 / 0, "c": lambda: 3}, skip=["c"])
    assert [(s.name, s.ok) for s in steps] == [("a", True), ("b", False)]
    audit = pipeline.Audit(str(tmp_path / "audit"))
    (tmp_path / "raw").mkdir()
    assert pipeline.reset(spark, str(tmp_path), ["raw"], "yes-flag", audit, "stage", dry_run=True) == ["raw"] and (tmp_path / "raw").exists()
    for path in ("", ".", "/", "a/.."):
        with pytest.raises(ValueError):
            pipeline.reset(spark, str(tmp_path), [path], "yes-flag", audit, "stage")
    with pytest.raises(PermissionError):
        pipeline.reset(spark, str(tmp_path), ["raw"], "api", audit, "all")
    assert pipeline.reset(spark, str(tmp_path), ["raw"], "api", audit, "all", token=pipeline.TOKEN) == ["raw"] and not (tmp_path / "raw").exists()
    assert audit.last(spark).count() == 2


def test_command_line(spark, tmp_path, capsys):
    from strandline import cli

    assert cli.main(["queries"]) == 0 and "pagerank" in capsys.readouterr().out.split()
    assert cli.main(["run", "topk", "--data", "/root/testdata/sf0.001", "--out", f"{tmp_path}/out"], spark) == 0
    assert spark.read.parquet(f"{tmp_path}/out/topk").count() == 5
    spark.range(10).write.parquet(f"{tmp_path}/staging/a.parquet")
    (tmp_path / "base.json").write_text(json.dumps({"a": 20}))
    staging = ["validate-staging", f"{tmp_path}/staging", "--baseline", f"{tmp_path}/base.json"]
    assert cli.main(staging, spark) == 0 and cli.main([*staging, "--strict"], spark) == 1
    assert cli.main([*staging, "--strict", "--drift-tolerance", "60"], spark) == 0
    (tmp_path / "root" / "raw").mkdir(parents=True)
    assert cli.main(["reset", f"{tmp_path}/root", "--stage", "raw", "--dry-run"], spark) == 0 and (tmp_path / "root" / "raw").exists()
    assert cli.main(["reset", f"{tmp_path}/root", "--all", "--yes"], spark) == 0 and not (tmp_path / "root" / "raw").exists()
    assert cli.main(["audit", f"{tmp_path}/root"], spark) == 0


def test_every_query_has_a_callable_and_sql_names_match():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(catalog.ORACLE_SQL) <= set(catalog.QUERIES)
