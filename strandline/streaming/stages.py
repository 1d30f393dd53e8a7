"""A chain of stages over batches that messages point to.

Each stage is a streaming query over a folder of messages. For each message not handled before it reads the batch, works
on it, writes the result under the batch's id (again for a repeated run), then the next stage's message, and last the
checkpoint row: a crash in between leads to the same files once more. What fails goes to the dead letters; the rest goes on.
"""

from __future__ import annotations

import json
import time
import traceback
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import analytics, graph, graph_store, parallels
from ..sources import schemas
from . import messages

#: Topics, in order.
TOPICS = ("pipeline.raw.landed", "pipeline.dedup.done", "pipeline.enrich.done", "pipeline.normalize.done")
STAGES = ("dedup", "enrich", "normalize", "ingest")
DEAD_LETTERS = "pipeline.dlq"
PREFIXES = ("raw/", "dedup/", "enriched/", "normalized/", "staged/")

Work = Callable[[DataFrame, str, str], DataFrame]


@dataclass(frozen=True)
class Layout:
    """Folders of a pipeline."""

    root: str

    def topic(self, name: str) -> str:
        return f"{self.root}/topics/{name}"

    def output(self, stage: str) -> str:
        return f"{self.root}/{stage}"

    @property
    def checkpoints(self) -> str:
        return f"{self.root}/checkpoints"

    @property
    def metrics(self) -> str:
        return f"{self.root}/metrics"

    def progress(self, stage: str) -> str:
        return f"{self.root}/progress/{stage}"


CHECKPOINT = "stage string, batch_id string, marked_at timestamp"
LETTER = "worker string, failed_at timestamp, error_class string, error_message string, error_traceback string, raw_payload string"


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    exists = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
    return spark.read.schema(schema).parquet(path) if exists else spark.createDataFrame([], schema)


def publish(spark: SparkSession, layout: Layout, topic: str, batch_id: str, source: str, path: str, count: int) -> None:
    row = spark.createDataFrame([(batch_id, source, path, datetime.now(timezone.utc), count)], "batch_id string, source string, b2_path string, timestamp timestamp, record_count int")
    row.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.mode("append").text(layout.topic(topic))


METRICS = "worker string, batch_id string, records_processed long, duration_seconds double, errors int, error_class string, at timestamp"


def measure(spark: SparkSession, layout: Layout, stage: str, batch_id: str, records: int | None, began: float, error: Exception | None = None) -> None:
    """One row for each batch: its records, its time, and whether it failed."""
    row = (stage, batch_id, records, time.monotonic() - began, int(error is not None), type(error).__name__ if error else None, datetime.now(timezone.utc))
    spark.createDataFrame([row], METRICS).coalesce(1).write.mode("append").parquet(layout.metrics)


def handle(layout: Layout, stage: str, work: Work, next_topic: str | None, batch: DataFrame) -> dict[str, int]:
    """One micro-batch of messages: counts of handled, skipped and failed ones."""
    spark = batch.sparkSession
    good, bad = messages.split(messages.parse(batch.select("value")))
    now = F.current_timestamp()
    letters = bad.select(F.lit(stage).alias("worker"), now.alias("failed_at"), F.lit("ValidationError").alias("error_class"), F.col("error").alias("error_message"), F.lit(None).cast("string").alias("error_traceback"), "raw_payload")
    letters.write.mode("append").parquet(layout.topic(DEAD_LETTERS))
    seen = read_or_empty(spark, layout.checkpoints, CHECKPOINT).where(F.col("stage") == stage).select("batch_id")
    earliest = good.groupBy("batch_id").agg(F.min(F.struct("timestamp", "b2_path", "source", "record_count")).alias("m")).select("batch_id", "m.*")
    todo = earliest.join(seen, "batch_id", "left_anti").orderBy("timestamp", "batch_id")
    counts = {"handled": 0, "failed": 0}
    for m in todo.toLocalIterator():  # a message stands for a batch of rows; the rows stay distributed
        began = time.monotonic()
        try:
            target = f"{layout.output(stage)}/{m['batch_id']}"
            result = work(placed(spark.read.parquet(m["b2_path"])), target, m["source"])
            if next_topic:
                publish(spark, layout, next_topic, m["batch_id"], m["source"], target, result.count())
            mark = spark.createDataFrame([(stage, m["batch_id"], datetime.now(timezone.utc))], CHECKPOINT)
            mark.coalesce(1).write.mode("append").parquet(layout.checkpoints)
            measure(spark, layout, stage, m["batch_id"], m["record_count"], began)
            counts["handled"] += 1
        except Exception as error:  # a batch that fails must not stop the stream
            letter = (stage, datetime.now(timezone.utc), type(error).__name__, str(error)[:2000], traceback.format_exc()[-8000:], json.dumps(m.asDict(), default=str))
            spark.createDataFrame([letter], LETTER).coalesce(1).write.mode("append").parquet(layout.topic(DEAD_LETTERS))
            measure(spark, layout, stage, m["batch_id"], None, began, error)
            counts["failed"] += 1
    return counts


def start(spark: SparkSession, layout: Layout, stage: str, work: Work, available_now: bool = True) -> StreamingQuery:
    """The streaming query of a stage over its topic's folder."""
    k = STAGES.index(stage)
    following = TOPICS[k + 1] if k + 1 < len(TOPICS) else None
    source = spark.readStream.schema("value string").text(layout.topic(TOPICS[k]))
    writer = source.writeStream.foreachBatch(lambda df, _: handle(layout, stage, work, following, df)).option("checkpointLocation", layout.progress(stage))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")).start()


def kafka(spark: SparkSession, servers: str, topic: str, group: str) -> DataFrame:
    """The same messages from a broker, where its connector is on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return reader.option("startingOffsets", "earliest").option("kafka.group.id", group).load().select(F.col("value").cast("string").alias("value"))


def placed(rows: DataFrame) -> DataFrame:
    """Rows of a batch with their place in it, by file name and row in the file, unless an earlier stage has given it."""
    return rows if "place" in rows.columns else rows.withColumn("place", F.struct(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")))


# ---- the work of each stage ----


def dedup(vector: str | None = "embedding", threshold: float = parallels.THRESHOLD) -> Work:
    """Rows as they are, and links between rows of the same batch; without vectors an empty table of links."""

    def work(rows: DataFrame, target: str, source: str) -> DataFrame:
        rows.write.mode("overwrite").parquet(target)
        if vector in rows.columns:
            found = parallels.neighbours(rows.where(F.col(vector).isNotNull()), "source_id", vector, threshold=threshold)
            links = parallels.links(found, rows.select(F.col("source_id").alias("id"), "source_corpus"))
        else:
            links = rows.sparkSession.createDataFrame([], schemas.schema("parallel_links"))
        links.write.mode("overwrite").parquet(f"{target}-links")
        return rows.sparkSession.read.parquet(target)

    return work


def enrich(lexicon: dict[str, list[str]] | None = None) -> Work:
    """Rows as they are, and topics of their texts beside them; without a lexicon none."""

    def work(rows: DataFrame, target: str, source: str) -> DataFrame:
        rows.write.mode("overwrite").parquet(target)
        topics = analytics.topics_lexical(rows, "source_id", "matn_en", lexicon) if lexicon else rows.sparkSession.createDataFrame([], schemas.schema("hadith_topics"))
        topics.write.mode("overwrite").parquet(f"{target}-topics")
        return rows.sparkSession.read.parquet(target)

    return work


def normalize() -> Work:
    """Nodes and edges of complete rows, one folder each, with the place of the row they come from and their number ``k`` in it."""

    def work(rows: DataFrame, target: str, source: str) -> DataFrame:
        complete = schemas.drop_incomplete(schemas.conform(rows, "hadiths", more=("place",)), "hadiths")
        nodes, links = graph.fan_out(complete, order="place", placed=True)
        none = F.lit(None).cast("string")
        part = nodes.select(F.lit("node").alias("kind"), "label", "id", *(none.alias(c) for c in ("src_id", "src_label", "dst_id", "dst_label")), "props", "place", "k")
        part = part.unionByName(links.select(F.lit("edge").alias("kind"), "label", none.alias("id"), "src_id", "src_label", "dst_id", "dst_label", "props", "place", "k"))
        part.write.mode("overwrite").partitionBy("kind", "label").parquet(target)
        return rows.sparkSession.read.parquet(target)

    return work


_ORD = "ord struct<version: bigint, file: string, row: bigint, k: int>"
GRAPH = {
    "nodes": graph_store.Table(f"label string, id string, props string, {_ORD}", ("label", "id")),
    "edges": graph_store.Table(f"label string, src_id string, src_label string, dst_id string, dst_label string, props string, {_ORD}", ("label", "src_id", "src_label", "dst_id", "dst_label")),
}


def graph_of(layout: Layout, buckets: int = 64) -> graph_store.Store:
    return graph_store.Store(f"{layout.root}/graph", GRAPH, buckets)


def ingest(layout: Layout, buckets: int = 64) -> Work:
    """Merges a batch into the graph: nodes first, then edges, all of which need their nodes; both are one commit. Later batches come
    after earlier ones, rows of a batch by their place, and what a row makes in its order."""

    def work(rows: DataFrame, target: str, source: str) -> DataFrame:
        spark, store = rows.sparkSession, graph_of(layout, buckets)
        version = store.entry(spark)["version"] + 1
        numbered = rows if "k" in rows.columns else rows.withColumn("k", F.lit(0))
        if "place" not in rows.columns:  # rows that no stage has placed: as they are read
            numbered = numbered.withColumn("place", F.struct(F.lit("").alias("file"), F.monotonically_increasing_id().alias("row")))
        order = F.struct(F.lit(version).cast("long").alias("version"), F.col("place.file").alias("file"), F.col("place.row").alias("row"), F.col("k").cast("int").alias("k")).alias("ord")
        new_nodes = graph.shape_props(numbered.where("kind = 'node'").select("label", "id", "props", order), schemas.NODE_PROPS)
        new_edges = graph.shape_props(numbered.where("kind = 'edge'").select("label", "src_id", "src_label", "dst_id", "dst_label", "props", order), schemas.EDGE_PROPS)
        ends = new_edges.select(F.col("src_label").alias("label"), F.col("src_id").alias("id")).union(new_edges.select("dst_label", "dst_id"))
        known = store.read(spark, "nodes", only=store.touched(ends, "label", "id")).select("label", "id").union(new_nodes.select("label", "id"))
        good = graph.require_endpoints(new_edges, known)
        written = {"nodes": store.write(spark, "nodes", new_nodes, merge_props, version), "edges": store.write(spark, "edges", good, merge_props, version)}
        store.commit(spark, version, written)
        store.expire(spark)
        return rows

    return work


def merge_props(old: DataFrame, new: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Nodes or edges whose property objects are merged name by name, the last value first; a null or missing property never
    clears one. Only rows whose keys come again are taken apart by name; the others are moved as they are."""
    both = old.unionByName(new)
    again = both.groupBy(*keys).count().where("count > 1").select(*(F.col(c).alias(f"__{c}") for c in keys))
    same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in keys))
    pairs = F.filter(F.map_entries(F.from_json("props", "map<string,string>")), lambda e: e["value"].isNotNull())
    single = both.join(again, same, "left_anti").select(*keys, _object(F.coalesce(pairs, F.array().cast("array<struct<key:string,value:string>>"))).alias("props"), "ord")
    long = both.join(again, same, "left_semi").select(*keys, "ord", F.explode_outer(F.from_json("props", "map<string,string>")).alias("name", "value"))
    latest = long.groupBy(*keys, "name").agg(F.max_by("value", F.when(F.col("value").isNotNull(), F.col("ord"))).alias("value"), F.max("ord").alias("ord"))
    entries = F.collect_list(F.when(F.col("value").isNotNull(), F.struct("name", "value")))
    return single.unionByName(latest.groupBy(*keys).agg(_object(entries).alias("props"), F.max("ord").alias("ord")))


def _object(entries: Column) -> Column:
    return F.to_json(F.map_from_entries(F.array_sort(entries)))


def current_graph(spark: SparkSession, layout: Layout) -> tuple[DataFrame, DataFrame]:
    store = graph_of(layout)
    return store.read(spark, "nodes"), store.read(spark, "edges")


# ---- housekeeping ----


def sweep(checkpoints: DataFrame, now: datetime, threshold: int = 100_000, days: int = 14) -> DataFrame:
    """Checkpoint rows without those of stages that have more than ``threshold`` and are older than ``days``."""
    sizes = checkpoints.groupBy("stage").count()
    old = F.col("marked_at") < F.lit(now - timedelta(days=days))
    return checkpoints.join(sizes, "stage").where(~((F.col("count") > threshold) & old)).drop("count")


def forget(checkpoints: DataFrame, first_stage: str) -> DataFrame:
    """Checkpoint rows without those of a stage and all after it, so that they run again."""
    return checkpoints.where(~F.col("stage").isin(*STAGES[STAGES.index(first_stage) :]))
