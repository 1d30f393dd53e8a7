"""Parsers of the eight raw sources into staging tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import casts, ids, text
from . import readers, schemas

#: English name, compiler, compilation year and reference count of the collections of the first source.
LK_COLLECTIONS = {
    "bukhari": ("Sahih al-Bukhari", "Muhammad ibn Ismail al-Bukhari", 256, 7563),
    "muslim": ("Sahih Muslim", "Muslim ibn al-Hajjaj", 261, 7563),
    "abu_dawud": ("Sunan Abu Dawud", "Abu Dawud al-Sijistani", 275, 5274),
    "tirmidhi": ("Jami' al-Tirmidhi", "Abu Isa al-Tirmidhi", 279, 3956),
    "nasai": ("Sunan al-Nasa'i", "Ahmad ibn Shu'ayb al-Nasa'i", 303, 5758),
    "ibn_majah": ("Sunan Ibn Majah", "Ibn Majah al-Qazwini", 273, 4341),
}
#: Collections of the first source by the names of its files, and else of its folders.
LK_FILES = {"albukhari": "bukhari", "almuslim": "muslim", "abudawud": "abu_dawud", "altirmidhi": "tirmidhi", "alnasai": "nasai", "ibnmajah": "ibn_majah"}
LK_FOLDERS = {"bukhari": "bukhari", "muslim": "muslim", "abudaud": "abu_dawud", "tirmizi": "tirmidhi", "nesai": "nasai", "ibnmaja": "ibn_majah"}
#: Fixed value: columns of the first source's files.
LK_COLUMNS = (
    "Chapter_Number Chapter_English Chapter_Arabic Section_Number Section_English Section_Arabic Hadith_number English_Hadith English_Isnad "
    "English_Matn Arabic_Hadith Arabic_Isnad Arabic_Matn Arabic_Comment English_Grade Arabic_Grade"
).split()
#: Header names under which a biography table may call its columns.
BIO_HEADERS = {
    "name_ar": ("name", "narrator_name", "name_ar", "narrator"),
    "name_en": ("english_name", "name_en", "name_english"),
    "kunya": ("kunya", "kunyah"),
    "nisba": ("nisba", "nisbah"),
    "laqab": ("laqab",),
    "birth_year_ah": ("birth_year", "birth", "birth_year_ah"),
    "death_year_ah": ("death_year", "death", "death_year_ah"),
    "birth_location": ("birth_location", "birth_place"),
    "death_location": ("death_location", "death_place"),
    "generation": ("generation", "tabaqa", "tabaqat"),
    "gender": ("gender", "sex"),
    "trustworthiness": ("trustworthiness", "rank", "grade", "jarh_tadil", "reliability"),
    "bio_text": ("bio", "biography", "bio_text", "description"),
    "bio_id": ("id", "narrator_id", "external_id"),
}


def by_synonym(df: DataFrame, synonyms: dict[str, Sequence[str]]) -> dict[str, Column]:
    """For each field the last column whose header is one of its names, whatever the case; null if there is none."""
    found = {f: [c for c in df.columns if c.strip().lower() in names] for f, names in synonyms.items()}
    return {f: F.col(f"`{cs[-1]}`") if cs else F.lit(None).cast("string") for f, cs in found.items()}


def _mapped(values: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in values.items() for x in pair)), key)


def collections(hadiths: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """One row for each collection of staged hadiths, with the number of them; ``names``: (collection_name, name_en) where a
    source has names of its own."""
    counted = hadiths.groupBy("source_corpus", "collection_name", "sect").agg(F.count("*").alias("total_hadiths"))
    if names is not None:
        counted = counted.join(names.dropDuplicates(["collection_name"]), "collection_name", "left")
    name = F.coalesce("name_en", "collection_name") if names is not None else F.col("collection_name")
    return schemas.conform(counted.withColumn("name_en", name).withColumn("collection_id", ids.source_id(F.col("source_corpus"), F.col("collection_name"))), "collections")


def lk(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Hadiths, mentions and collections of files whose own or whose folder's name is that of a collection; others are left out."""
    raw = readers.good_rows(readers.csv(spark, f"{folder}/", columns=LK_COLUMNS, file=True, recursive=True))
    parts = F.split("file.path", "/")
    file, parent = F.lower(F.regexp_replace(F.element_at(parts, -1), r"\.[^.]+$", "")), F.lower(F.element_at(parts, -2))
    collection = F.coalesce(_mapped(LK_FILES, file), _mapped(LK_FOLDERS, parent))
    field = {c: text.strip_html(F.col(c)) for c in LK_COLUMNS}
    rows = raw.select(
        F.lit("lk").alias("source_corpus"), collection.alias("collection_name"),
        casts.safe_int(F.col("Chapter_Number")).alias("chapter_number"), casts.safe_int(F.col("Hadith_number")).alias("hadith_number"),
        field["Arabic_Matn"].alias("matn_ar"), field["English_Matn"].alias("matn_en"), field["Arabic_Isnad"].alias("isnad_raw_ar"), field["English_Isnad"].alias("isnad_raw_en"),
        field["Arabic_Hadith"].alias("full_text_ar"), field["English_Hadith"].alias("full_text_en"), F.coalesce(field["English_Grade"], field["Arabic_Grade"]).alias("grade"),
        field["Chapter_Arabic"].alias("chapter_name_ar"), field["Chapter_English"].alias("chapter_name_en"), F.lit("sunni").alias("sect"),
    )
    rows = rows.where("collection_name IS NOT NULL").withColumn("source_id", ids.source_id("lk", F.col("collection_name"), F.col("chapter_number"), F.col("hadith_number")))
    facts = spark.createDataFrame([(k, *v[:3]) for k, v in LK_COLLECTIONS.items()], "collection_name string, name_en string, compiler_name string, compilation_year_ah int")
    counted = rows.groupBy("collection_name").agg(F.count("*").alias("total_hadiths")).join(F.broadcast(facts), "collection_name")
    known = counted.withColumn("collection_id", F.concat(F.lit("lk:"), "collection_name")).withColumn("sect", F.lit("sunni")).withColumn("source_corpus", F.lit("lk"))
    from ..operators import chains

    hadiths = schemas.conform(rows, "hadiths")
    return hadiths, schemas.conform(chains.mentions(hadiths, ("en", "ar")), "narrator_mentions"), schemas.conform(known, "collections")


def _numbered(raw: DataFrame) -> DataFrame:
    """Rows with their place in their file: files of several lines a row aren't split, so their rows have consecutive numbers ``mid``."""
    first = raw.groupBy(F.col("file.path").alias("path")).agg(F.min("mid").alias("first"))
    return raw.join(first, F.col("file.path") == F.col("path")).withColumn("row", (F.col("mid") - F.col("first")).cast("int"))


def sanadset(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Hadiths and mentions of tagged texts; an isnad of only a note that there is none is null."""
    raw = readers.csv(spark, path, file=True).withColumn("mid", F.monotonically_increasing_id())
    numbered = _numbered(raw)
    sanad = text.tag_body(F.col("hadith"), "SANAD")
    chain = F.when(~F.lower(sanad).isin("no sanad", ""), sanad)
    rows = numbered.select(
        F.lit("sanadset").alias("source_corpus"), F.lit("sanadset").alias("collection_name"),
        casts.safe_int(F.col("book_id")).alias("book_number"), casts.safe_int(F.col("hadith_id")).alias("hadith_number"), "row",
        text.tag_body(F.col("hadith"), "MATN").alias("matn_ar"), F.nullif(text.strip(F.regexp_replace(chain, "<[^>]+>", "")), F.lit("")).alias("isnad_raw_ar"),
        F.nullif(text.strip(F.regexp_replace("hadith", "<[^>]+>", "")), F.lit("")).alias("full_text_ar"), casts.safe_str(F.col("grade")).alias("grade"),
        F.lit("sunni").alias("sect"), text.tag_bodies(chain, "NAR").alias("names"), text.between_tags(chain, "NAR").alias("phrases"),
    )
    rows = rows.withColumn("source_id", ids.source_id("sanadset", F.col("collection_name"), F.col("book_number"), F.col("hadith_number"), F.col("row")))
    named = rows.where("names IS NOT NULL").select("source_id", F.posexplode(F.arrays_zip("names", "phrases")).alias("position_in_chain", "n"))
    mentions = named.where("n.names <> ''").select(
        F.concat_ws(":", F.lit("sanadset:mention"), "source_id", "position_in_chain").alias("mention_id"), F.col("source_id").alias("source_hadith_id"),
        F.lit("sanadset").alias("source_corpus"), "position_in_chain", F.col("n.names").alias("name_ar"),
        text.normalize_arabic(F.col("n.names")).alias("name_ar_normalized"), F.nullif(F.col("n.phrases"), F.lit("")).alias("transmission_method"),
    )
    return schemas.conform(rows, "hadiths"), schemas.conform(mentions, "narrator_mentions")


def bios(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Biographies from a CSV with any known headers; of repeated ids the first stays."""
    raw = readers.csv(spark, path).withColumn("mid", F.monotonically_increasing_id())
    f = by_synonym(raw, BIO_HEADERS)
    first = raw.withColumn("bio_id", F.concat(F.lit(f"{source}:"), casts.safe_str(f["bio_id"])))
    first = first.withColumn("nth", F.row_number().over(Window.partitionBy("bio_id").orderBy("mid"))).where("nth = 1 AND bio_id IS NOT NULL")
    texts = {k: casts.safe_str(v).alias(k) for k, v in f.items() if k not in ("bio_id", "birth_year_ah", "death_year_ah")}
    out = first.select(
        "bio_id", F.lit(source).alias("source"), casts.safe_str(f["bio_id"]).alias("external_id"), *texts.values(),
        casts.safe_int(f["birth_year_ah"]).alias("birth_year_ah"), casts.safe_int(f["death_year_ah"]).alias("death_year_ah"),
    )
    out = out.withColumn("name_ar_normalized", text.normalize_arabic(F.col("name_ar"))).withColumn("name_en_normalized", F.lower(F.trim("name_en")))
    return schemas.conform(out, "narrators_bio")


_BOOK_ITEM = "hadithNumber string, number string, id string, textAr string, arabicText string, textEn string, englishText string, grade string, majlisiGrading string, chapterEn string, chapter string, chapterAr string, chapterNumber string, chapterId string, bookName string, book string, bookNameAr string"


def thaqalayn(spark: SparkSession, path: str) -> DataFrame:
    """Books as lists of items, or wrapped in an object with a list."""
    items = readers.json_items(readers.json_documents(spark, path), _BOOK_ITEM)
    wrapped = lambda k: F.nullif(F.get_json_object("value", f"$.{k}"), F.lit(""))
    book = casts.safe_int(F.regexp_extract("file_name", r"(\d+)", 1))
    rows = items.select(
        F.lit("thaqalayn").alias("source_corpus"), text.collection_slug(F.coalesce(wrapped("bookName"), casts.first_truthy(F.col("bookName"), F.col("book")), F.lit("unknown"))).alias("collection_name"),
        book.alias("book_number"), casts.safe_int(casts.first_truthy(F.col("chapterNumber"), F.col("chapterId"))).alias("chapter_number"),
        casts.safe_int(casts.first_truthy(F.col("hadithNumber"), F.col("number"), F.col("id"))).alias("hadith_number"),
        casts.first_truthy(F.col("textAr"), F.col("arabicText")).alias("full_text_ar"), casts.first_truthy(F.col("textEn"), F.col("englishText")).alias("full_text_en"),
        casts.first_truthy(F.col("grade"), F.col("majlisiGrading")).alias("grade"), F.col("chapterAr").alias("chapter_name_ar"), casts.first_truthy(F.col("chapterEn"), F.col("chapter")).alias("chapter_name_en"), F.lit("shia").alias("sect"),
    )
    rows = rows.withColumns({"matn_ar": F.col("full_text_ar"), "matn_en": F.col("full_text_en"), "source_id": ids.source_id("thaqalayn", F.col("collection_name"), F.col("book_number"), F.col("hadith_number"))})
    return schemas.conform(rows, "hadiths")


_EDITION = "metadata struct<name:string,author:string>, hadiths array<struct<hadithnumber:string,text:string,grades:array<struct<name:string,grade:string>>>>"


def merge_editions(english: DataFrame, arabic: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Every English row with the last Arabic text of its keys, then Arabic rows whose keys no English row has."""
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(order).desc()))
    one = arabic.withColumn("nth", last).where("nth = 1").select(*(F.col(k).alias(f"__{k}") for k in keys), F.col("text").alias("text_ar"))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    both = english.withColumnRenamed("text", "text_en").join(one, same, "left").select(*keys, "grades", "text_en", "text_ar")
    taken = english.select(*(F.col(k).alias(f"__{k}") for k in keys))
    only = arabic.join(taken, same, "left_anti").select(*keys, "grades", F.lit(None).cast("string").alias("text_en"), F.col("text").alias("text_ar"))
    return both.unionByName(only)


def fawaz(spark: SparkSession, folder: str) -> DataFrame:
    """English and Arabic editions of a collection, merged by number."""
    files = readers.json_array(spark, f"{folder}/*-*.json", _EDITION)
    edition = F.regexp_replace("file_name", r"\.json$", "")
    rows = files.select(F.split(edition, "-")[0].alias("lang"), text.edition_collection(edition).alias("collection_name"), text.detect_sect(F.concat_ws(" ", F.coalesce("metadata.name", F.lit("")), edition)).alias("sect"), F.posexplode("hadiths").alias("ord", "h"))
    rows = rows.select("lang", "collection_name", "sect", "ord", casts.safe_int(F.col("h.hadithnumber")).alias("hadith_number"), F.col("h.text").alias("text"), F.when(F.size("h.grades") > 0, F.to_json("h.grades")).alias("grades"))
    english = rows.where("lang = 'eng'")
    # the sect is that of the English edition, where there is one
    sects = english.groupBy("collection_name").agg(F.min("sect").alias("own"))
    arabic = rows.where("lang = 'ara'").join(sects, "collection_name", "left").withColumn("sect", F.coalesce("own", "sect")).drop("own")
    merged = merge_editions(english, arabic, ["collection_name", "sect", "hadith_number"], "ord")
    out = merged.select(
        F.lit("fawaz").alias("source_corpus"), "collection_name", "hadith_number", "sect", F.col("grades").alias("grade"),
        F.col("text_ar").alias("matn_ar"), F.col("text_en").alias("matn_en"), F.col("text_ar").alias("full_text_ar"), F.col("text_en").alias("full_text_en"),
        ids.source_id("fawaz", F.col("collection_name"), F.col("hadith_number")).alias("source_id"),
    )
    return schemas.conform(out, "hadiths")


_API_ITEM = "hadithNumber string, bookNumber string, chapterNumber string, hadith array<struct<lang:string,body:string>>, body string, grades array<struct<grade:string>>, chapterTitle string"


def fawaz_names(spark: SparkSession, folder: str) -> DataFrame:
    """(collection_name, name_en) as English editions name themselves."""
    files = readers.json_array(spark, f"{folder}/eng-*.json", _EDITION)
    return files.select(text.edition_collection(F.regexp_replace("file_name", r"\.json$", "")).alias("collection_name"), F.col("metadata.name").alias("name_en"))


def sunnah_api(spark: SparkSession, folder: str) -> DataFrame:
    """Cached pages of an API: bodies by language, grades as one value or a list."""
    items = readers.json_array(spark, f"{folder}/*_hadiths.json", _API_ITEM)
    collection = F.regexp_replace("file_name", r"_hadiths\.json$", "")
    arabic, english = casts.language_body(F.col("hadith"), "ar"), F.coalesce(casts.language_body(F.col("hadith"), "en"), F.col("body"))
    rows = items.select(
        F.lit("sunnah").alias("source_corpus"), collection.alias("collection_name"), casts.safe_int(F.col("bookNumber")).alias("book_number"), casts.safe_int(F.col("chapterNumber")).alias("chapter_number"),
        casts.safe_int(F.col("hadithNumber")).alias("hadith_number"), arabic.alias("matn_ar"), english.alias("matn_en"), arabic.alias("full_text_ar"), english.alias("full_text_en"),
        casts.json_or_scalar(F.col("grades.grade")).alias("grade"), F.col("chapterTitle").alias("chapter_name_en"), F.lit("sunni").alias("sect"),
    )
    return schemas.conform(rows.withColumn("source_id", ids.source_id("sunnah", F.col("collection_name"), F.col("book_number"), F.col("hadith_number"))), "hadiths")


_SCRAPED_ITEM = "hadith_number string, book_number string, chapter_number string, text_ar string, text_en string, grade string, chapter_name_ar string, chapter_name_en string"


def sunnah_scraped(spark: SparkSession, folder: str) -> DataFrame:
    """Scraped lists, without the manifest; grades split at semicolons."""
    items = readers.json_array(spark, f"{folder}/*.json", _SCRAPED_ITEM).where("file_name <> 'manifest.json' AND file_name NOT LIKE '.%'")
    grades = F.transform(F.split("grade", ";"), text.strip)
    rows = items.select(
        F.lit("sunnah").alias("source_corpus"), F.regexp_replace("file_name", r"\.json$", "").alias("collection_name"),
        casts.safe_int(F.col("book_number")).alias("book_number"), casts.safe_int(F.col("chapter_number")).alias("chapter_number"), casts.safe_int(F.col("hadith_number")).alias("hadith_number"),
        F.col("text_ar").alias("matn_ar"), F.col("text_en").alias("matn_en"), F.col("text_ar").alias("full_text_ar"), F.col("text_en").alias("full_text_en"),
        casts.json_or_scalar(grades).alias("grade"), "chapter_name_ar", "chapter_name_en", F.lit("sunni").alias("sect"),
    )
    return schemas.conform(rows.withColumn("source_id", ids.source_id("sunnah", F.col("collection_name"), F.col("book_number"), F.col("chapter_number"), F.col("hadith_number"))), "hadiths")


def open_hadith(spark: SparkSession, path: str) -> DataFrame:
    """Files without headers: number and text; a missing number is the row's place."""
    raw = readers.csv(spark, path, header=False, file=True).withColumn("mid", F.monotonically_increasing_id())
    raw = _numbered(raw)
    row = F.col("row") + 1
    rows = raw.select(
        F.lit("open_hadith").alias("source_corpus"), text.file_collection(F.col("file.name")).alias("collection_name"), F.coalesce(casts.safe_int(F.col("_c0")), row).alias("hadith_number"),
        casts.safe_str(F.col("_c1")).alias("full_text_ar"), F.lit("sunni").alias("sect"),
    )
    rows = rows.withColumn("matn_ar", F.col("full_text_ar")).withColumn("source_id", ids.source_id("open_hadith", F.col("collection_name"), F.col("hadith_number")))
    return schemas.conform(rows, "hadiths")


def muhaddithat_edges(narrators: DataFrame, hadiths: DataFrame) -> DataFrame:
    """Edges between neighbours of each comma-separated chain, with names where ids are known; no loops."""
    chain = hadiths.select(F.col("id").alias("hadith_id"), F.posexplode(F.filter(F.transform(F.split("narrator_ids", ","), text.strip), lambda n: n != "")).alias("pos", "from_external_id"))
    pairs = chain.withColumn("to_external_id", F.lead("from_external_id").over(Window.partitionBy("hadith_id").orderBy("pos"))).where("to_external_id IS NOT NULL AND from_external_id <> to_external_id")
    names = narrators.select(F.col("id").cast("string").alias("nid"), F.col("name").alias("nname")).dropDuplicates(["nid"])
    out = pairs.join(names, F.col("nid") == F.col("from_external_id"), "left").withColumn("from_narrator_name", F.coalesce("nname", "from_external_id")).drop("nid", "nname")
    out = out.join(names, F.col("nid") == F.col("to_external_id"), "left").withColumn("to_narrator_name", F.coalesce("nname", "to_external_id"))
    return schemas.conform(out.withColumn("source", F.lit("muhaddithat")), "network_edges")


def enrich_metadata(editions: DataFrame, scraped: DataFrame) -> DataFrame:
    """Editions with book, chapter and chapter names of scraped rows of the same collection and number, where they have none."""
    fill = ["book_number", "chapter_number", "chapter_name_ar", "chapter_name_en"]
    key = [text.collection_slug(F.col("collection_name")).alias("slug"), F.col("hadith_number").alias("number")]
    last = Window.partitionBy("slug", "number").orderBy(F.col("source_id").desc())
    index = scraped.select(*key, "source_id", *fill).where("number IS NOT NULL").withColumn("nth", F.row_number().over(last)).where("nth = 1").select("slug", "number", *(F.col(c).alias(f"new_{c}") for c in fill))
    joined = editions.withColumn("slug", key[0]).withColumn("number", F.col("hadith_number")).join(index, ["slug", "number"], "left")
    return schemas.conform(joined.withColumns({c: F.coalesce(c, f"new_{c}") for c in fill}), "hadiths")
