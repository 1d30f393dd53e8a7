"""Scans: Parquet by prefix, CSV with fallbacks, JSON by shape, YAML-like curated lists, files with digests, paginated HTTP."""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from html.parser import HTMLParser
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def parquet(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def parquet_by_prefix(spark: SparkSession, folder: str, prefix: str) -> DataFrame:
    """All files whose names begin with a prefix, with ``file_name`` to keep their order."""
    return spark.read.option("mergeSchema", "true").parquet(f"{folder}/{prefix}*.parquet").withColumn("file_name", F.col("_metadata.file_name"))


def row_count(spark: SparkSession, path: str) -> int:
    """From file footers only."""
    return spark.read.parquet(path).count()


def not_utf8(spark: SparkSession, path: str, recursive: bool = False) -> list[str]:
    """Files with a line that isn't valid UTF-8: files are read line by line, in splits, and only their names come back."""
    lines = spark.read.option("recursiveFileLookup", str(recursive).lower()).text(path).select("value", F.col("_metadata.file_path").alias("file"))
    return sorted(r["file"] for r in lines.where(~F.is_valid_utf8("value")).select("file").distinct().collect())


def csv_encoding(spark: SparkSession, path: str) -> str:
    """UTF-8 if every file is valid in it (with or without a mark), else Latin-1."""
    return "ISO-8859-1" if not_utf8(spark, path) else "UTF-8"


def csv(
    spark: SparkSession, path: str, header: bool = True, bad_rows: str = "PERMISSIVE", columns: Sequence[str] | None = None, file: bool = False, recursive: bool = False
) -> DataFrame:
    """CSV as strings, each file as UTF-8 if it is valid in it, else as Latin-1. With ``columns``, rows of another width go to
    ``_corrupt_record`` (PERMISSIVE) or away (DROPMALFORMED). ``file``: with the path and name of each row's file as the struct ``file``."""

    def read(encoding: str) -> DataFrame:
        reader = spark.read.option("encoding", encoding).option("multiLine", "true").option("escape", '"').option("mode", bad_rows).option("recursiveFileLookup", str(recursive).lower())
        if columns:
            fields = ", ".join(f"`{c}` string" for c in columns)
            corrupt = ", _corrupt_record string" if bad_rows == "PERMISSIVE" else ""
            reader = reader.schema(fields + corrupt).option("columnNameOfCorruptRecord", "_corrupt_record")
        return reader.option("header", str(header).lower()).csv(path)

    latin = not_utf8(spark, path, recursive)
    place = F.col("_metadata.file_path")
    own = [F.struct(place.alias("path"), F.col("_metadata.file_name").alias("name")).alias("file")] if file else []
    df = read("UTF-8")
    names = [c.lstrip("\ufeff") for c in df.columns] + (["file"] if file else [])
    if not latin:
        return df.select("*", *own).toDF(*names)
    both = df.where(~place.isin(latin)).select("*", *own).toDF(*names)
    other = read("ISO-8859-1")
    return both.unionByName(other.where(place.isin(latin)).select("*", *own).toDF(*[c.lstrip("\ufeff") for c in other.columns], *(["file"] if file else [])), allowMissingColumns=True)


def good_rows(df: DataFrame) -> DataFrame:
    """Rows of the right width. The test also reads a first column, as CSV can't be asked for corrupt records alone."""
    if "_corrupt_record" not in df.columns:
        return df
    first = F.length(F.coalesce(F.col(f"`{df.columns[0]}`"), F.lit(""))) >= 0
    return df.where(F.col("_corrupt_record").isNull() & first).drop("_corrupt_record")


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file with a JSON array, or one object, with the file's name."""
    return spark.read.schema(schema).option("multiLine", "true").json(path).withColumn("file_name", F.col("_metadata.file_name"))


def json_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole JSON files as text, for sources whose shape has to be looked at first."""
    return spark.read.option("wholetext", "true").text(path).select("value", F.col("_metadata.file_name").alias("file_name"))


def json_items(documents: DataFrame, item_schema: str, keys: Sequence[str] = ("data", "hadiths")) -> DataFrame:
    """The items of each document: of the list that it is, of the first listed key that holds one, or the document itself."""
    text = F.col("value")
    shapes = [F.from_json(text, f"array<struct<{item_schema}>>")]
    shapes += [F.from_json(F.get_json_object(text, f"$.{k}"), f"array<struct<{item_schema}>>") for k in keys]
    one = F.array(F.from_json(text, f"struct<{item_schema}>"))
    is_list = F.ltrim(text).startswith("[")
    found = F.when(is_list, shapes[0])
    for key, shape in zip(keys, shapes[1:], strict=True):
        found = found.when(F.get_json_object(text, f"$.{key}").startswith("["), shape)
    return documents.select("file_name", "value", F.posexplode(found.otherwise(one)).alias("item_no", "item")).select("file_name", "value", "item_no", "item.*")


def curated(spark: SparkSession, rows: list[dict[str, Any]], schema: str) -> DataFrame:
    """A short hand-written list, such as a YAML file holds."""
    return spark.createDataFrame(rows, schema)


def curated_yaml(spark: SparkSession, path: str, key: str, schema: str) -> DataFrame:
    """The list under a key of a YAML file, which the driver reads whole."""
    import yaml

    text = spark.read.option("wholetext", "true").text(path).first()[0]
    return curated(spark, yaml.safe_load(text)[key], schema)


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """name, size, modification time, md5 and sha256 of each file."""
    files = spark.read.format("binaryFile").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(name.alias("name"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"), F.md5("content").alias("md5"), F.sha2("content", 256).alias("sha256"))


class _Pages(InputPartition):
    """Pages ``first``, ``first + step``, ... of an API."""

    def __init__(self, first: int, step: int) -> None:
        self.first, self.step = first, step


class _PagesReader(DataSourceReader):
    """Pages are asked for until one is empty, the total is reached or ``max_pages`` are read, by as many readers as ``readers``, which take turns."""

    def __init__(self, options: dict[str, str]) -> None:
        self.options = options

    def partitions(self) -> Sequence[InputPartition]:
        first, readers = int(self.options.get("first", 1)), int(self.options.get("readers", 1))
        return [_Pages(first + k, readers) for k in range(readers)]

    def _fetch(self, url: str) -> Any:
        with urllib.request.urlopen(url, timeout=60) as answer:  # type: ignore[attr-defined]
            return json.load(answer)

    def read(self, partition: InputPartition) -> Iterator[tuple[str, str]]:
        o = self.options
        key, limit, first = o.get("key", "data"), int(o.get("limit", "50")), int(o.get("first", 1))
        last = first + int(o.get("pages", o.get("max_pages", "1000"))) - 1
        for page in range(partition.first, last + 1, partition.step):
            url = f"{o['url']}{'&' if '?' in o['url'] else '?'}{o.get('page_param', 'page')}={page}&{o.get('limit_param', 'limit')}={limit}"
            found = self._fetch(url)
            items, total = (found.get(key, []), found.get(o.get("total_key", "total"))) if isinstance(found, dict) else (found, None)
            if not items:
                return
            for item in items:
                yield url, json.dumps(item, ensure_ascii=False)
            if total is not None and (page - first) * limit + len(items) >= int(total):
                return


class PaginatedJson(DataSource):
    """``spark.read.format("paginated_json")``: pages of a JSON API until there are no more; rows (page_url, item)."""

    @classmethod
    def name(cls) -> str:
        return "paginated_json"

    def schema(self) -> str:
        return "page_url string, item string"

    def reader(self, schema: Any) -> DataSourceReader:
        return _PagesReader(dict(self.options))


class _Selector(HTMLParser):
    """Texts of elements that match ``tag.class`` selectors; for each field the first selector that finds anything counts."""

    def __init__(self, selectors: dict[str, list[str]]) -> None:
        super().__init__(convert_charrefs=True)
        self.wanted = [(f, k, *(s.split(".", 1) + [""])[:2]) for f, ss in selectors.items() for k, s in enumerate(ss)]
        self.open: list[tuple[str, list[tuple[str, int]]]] = []
        self.found: dict[tuple[str, int], list[str]] = {}

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        classes = (dict(attrs).get("class") or "").split()
        hits = [(f, k) for f, k, t, c in self.wanted if t in ("", tag) and (not c or c in classes)]
        if tag not in ("br", "img", "hr", "input", "meta", "link"):
            self.open.append((tag, hits))
        for hit in hits:
            self.found.setdefault(hit, []).append("")

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                break

    def handle_data(self, data: str) -> None:
        for _, hits in self.open:
            for hit in hits:
                self.found[hit][-1] += data


def scrape(pages: DataFrame, selectors: dict[str, list[str]], html: str = "html") -> DataFrame:
    """Pages with a column for each field: the text of the first element that its selectors find, in the order given."""

    def fields(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: dict[str, list[str | None]] = {f: [] for f in selectors}
            for page in batch[html]:
                parser = _Selector(selectors)
                parser.feed(page or "")
                for f, alternatives in selectors.items():
                    texts = next((parser.found[f, k] for k in range(len(alternatives)) if (f, k) in parser.found), [""])
                    out[f].append(" ".join(texts[0].split()) or None)
            yield batch.assign(**out)

    kinds = ", ".join([f"`{n}` {t}" for n, t in pages.dtypes] + [f"`{f}` string" for f in selectors])
    return pages.mapInPandas(fields, kinds)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def each_source(sources: dict[str, Callable[[], DataFrame]]) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """All sources that can be read, and what kept the others from it."""
    good, bad = {}, {}
    for name, make in sources.items():
        try:
            good[name] = make()
        except Exception as error:  # a source that fails must not stop the others
            bad[name] = f"{type(error).__name__}: {error}"
    return good, bad
