"""The engine's inputs, derived from the given tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicstream.functions.vectors import round2
from topicstream.operators.features import preprocess
from topicstream.operators.model import vector_mean
from topicstream.operators.quality import assign, cluster_quality, interesting_flag
from topicstream.session import new_run_dir, staged_table
from topicstream.sources.outputs import read_batches, write_batch

BATCHES = 4


SMALL_ROWS = 1_000_000
LINES_PER_TASK = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows are costly to process.

    A small table is often one file with one row group, which only a single task can read; it is spread over all
    cores. Larger tables come in as many tasks as they have row groups and are not shuffled.
    """
    df = table(spark, sf_dir, name)
    small = df.count() < SMALL_ROWS  # answered from the file footers
    return df.repartition(spark.sparkContext.defaultParallelism) if small else df


def spread(df: DataFrame, rows: int) -> DataFrame:
    """Short rows that are costly to process, dealt out to as many tasks as their number asks for, whatever files they come in."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // LINES_PER_TASK)))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as posts; the number of the source serves as a given cluster. Posts share links by source, language and id."""
    docs = texts(spark, sf_dir, "documents")
    page = F.when(F.col("lang") != "en", F.concat_ws("/", "source", "lang"))
    front = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("front/"), (F.col("doc_id") % 3).cast("string")))
    return docs.select(
        F.col("doc_id").alias("id"),
        "text",
        F.array_compact(F.array(page, front)).alias("urls"),
        F.regexp_extract("source", r"(\d+)", 1).cast("long").alias("source"),
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preprocess(posts(spark, sf_dir).select("id", "text", "source"))


def centers(vectors: DataFrame, vector: str = "tfidf") -> DataFrame:
    """A model of the mean vectors per ``cluster_id``, weighted by their row counts."""
    means = vector_mean(vectors.select("cluster_id", vector), vector)
    n = F.col("n")
    return means.select(
        "cluster_id", F.transform("total", lambda x: x / n).alias("center"), n.cast("double").alias("weight")
    )


def source_model(posts_with_vectors: DataFrame) -> DataFrame:
    """Fixed centers: the mean TF-IDF vector of every source."""
    rows = posts_with_vectors.withColumnRenamed("source", "cluster_id")
    return staged_table(centers(rows), "source-model")


def assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts assigned to the fixed centers, numbered as batches by id. Stored, as the online job does."""
    rows = staged_table(preprocess(posts(spark, sf_dir), keep_text=True), "features")
    hits = assign(rows, source_model(rows)).withColumn("batch_id", F.pmod("id", F.lit(BATCHES)))
    keep = ["batch_id", "id", "cluster_id", "neighbor_id", "text", "urls", "vec_sum", "own", "other"]
    return staged_table(hits.select(*keep), "assigned")


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_quality(assigned(spark, sf_dir), ["batch_id", "cluster_id"])


def event_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cluster report with gaps: users and event types as clusters, weeks as batches (ids 2, 5, 8, ...)."""
    e = table(spark, sf_dir, "events")
    week = F.floor(F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")) / 7)
    rows = e.select(
        (week * 3 + 2).alias("batch_id"),
        (F.col("user_id") * 10 + F.ascii("event_type") % 10).alias("cluster_id"),
        "event_id",
        "event_type",
        "value",
    )
    cells = rows.groupBy("batch_id", "cluster_id").agg(
        F.count("*").alias("count"),
        F.avg("value").alias("mean"),
        F.max("value").alias("top"),
        F.min("event_id").alias("rep_id"),
        F.max("event_type").alias("rep_text"),
    )
    # as IEEE division, also where the greatest value is 0
    unbounded = F.when(F.col("mean") == 0, F.lit(math.nan)).when(F.col("mean") > 0, F.lit(math.inf)).otherwise(F.lit(-math.inf))
    zero = F.col("top") == 0
    silhouette = F.when(zero, unbounded).otherwise(F.col("mean") / F.col("top"))
    return cells.select(
        "batch_id",
        "cluster_id",
        "count",
        F.when(zero, silhouette).otherwise(round2(silhouette)).alias("silhouette"),
        round2(F.col("mean")).alias("intra"),
        round2(F.col("top")).alias("inter"),
        interesting_flag(F.col("count"), silhouette).alias("interesting"),
        "rep_id",
        "rep_text",
        F.lit("none").alias("best_url"),
    )


def stored(df: DataFrame, name: str) -> tuple[str, DataFrame]:
    """``df`` written batch by batch through the sinks; returns the run folder and the stored table."""
    spark = df.sparkSession
    out = new_run_dir(spark, "outputs")
    df = df.persist()
    for batch in [r[0] for r in df.select("batch_id").distinct().orderBy("batch_id").collect()]:
        write_batch(df.filter(F.col("batch_id") == batch).drop("batch_id"), out, name, batch)
    df.unpersist()
    return out, read_batches(spark, out, name)


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return rows.select(
        F.col("vec_id").alias("id"),
        F.col("embedding").cast("array<double>").alias("tfidf"),
        F.col("label").cast("long").alias("cluster_id"),
    )


def label_model(vectors: DataFrame) -> DataFrame:
    return staged_table(centers(vectors), "label-model")


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw API lines: one mention per record; errors are control messages."""
    events = table(spark, sf_dir, "events")
    count = events.count()  # answered from the file footers
    e = spread(events, count)
    none = F.array().cast("array<struct<expanded_url:string>>")
    record = F.struct(
        F.col("event_id").alias("id"),
        F.concat_ws(" ", "event_type", "props").alias("text"),
        F.lit("en").alias("lang"),
        F.unix_millis(F.col("ts").cast("timestamp")).cast("string").alias("timestamp_ms"),
        F.struct(
            ((F.col("user_id") + 1) % 150).alias("id"),
            F.concat(F.lit("u"), ((F.col("user_id") + 1) % 150).cast("string")).alias("screen_name"),
            F.floor("value").alias("followers_count"),
        ).alias("user"),
        F.struct(
            F.array(
                F.struct(F.col("event_type").alias("text")),
                F.struct(F.concat(F.lit("k"), F.get_json_object("props", "$.k")).alias("text")),
            ).alias("hashtags"),
            none.alias("urls"),
            F.array(F.struct(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("screen_name"))).alias(
                "user_mentions"
            ),
        ).alias("entities"),
    )
    line = F.to_json(record)
    control = F.concat(F.lit('{"delete":null,'), F.substring(line, F.lit(2), F.length(line)))
    lines = e.select(F.when(F.col("event_type") == "error", control).otherwise(line).alias("raw"))
    stored_lines = staged_table(lines, "raw-lines")  # a collector's lines are stored text
    return spread(stored_lines, count) if count > LINES_PER_TASK else stored_lines


def thread_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as raw lines: the last turn quotes the turn before it, and so on back to the first.

    Every conversation comes twice, once with its system turns in a language that is not followed, once all in English.
    """
    turns = texts(spark, sf_dir, "conversations").withColumn("plain", F.explode(F.array(F.lit(False), F.lit(True))))
    thread = turns.groupBy("conv_id", "plain").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))

    def nest(quoted, turn):
        lang = F.when((turn["role"] == "system") & ~F.col("plain"), "xx").otherwise("en")
        post = F.to_json(
            F.struct(
                (F.col("conv_id") * 1000 + turn["turn"] + F.when(F.col("plain"), 500).otherwise(0)).alias("id"),
                turn["text"].alias("text"),
                lang.alias("lang"),
                turn["turn"].cast("string").alias("timestamp_ms"),
                F.struct(turn["role"].alias("screen_name")).alias("user"),
            )
        )
        opened = F.substring(post, F.lit(1), F.length(post) - 1)
        return F.concat(opened, F.when(quoted == "", "").otherwise(F.concat(F.lit(',"quoted_status":'), quoted)), F.lit("}"))

    return staged_table(thread.select(F.aggregate("turns", F.lit(""), nest).alias("raw")), "raw-threads")


def quoting_records(lines: DataFrame) -> DataFrame:
    """Raw event lines, each quoting a post with a mention of its own; every other quote is not English."""
    lang = F.when(F.pmod(F.crc32(F.col("raw").cast("binary")), F.lit(2)) == 0, "en").otherwise("de")
    inner = F.concat(
        F.lit('{"id":1,"text":"quoted","lang":"'), lang, F.lit('","entities":{"user_mentions":[{"screen_name":"inner"}]}}')
    )
    body = F.substring(F.col("raw"), F.lit(1), F.length("raw") - 1)
    return lines.select(F.concat(body, F.lit(',"quoted_status":'), inner, F.lit("}")).alias("raw"))


def post_lines(spark: SparkSession, sf_dir: str) -> str:
    """All documents as collected JSON lines in a fresh folder."""
    docs = table(spark, sf_dir, "documents")
    lines = docs.select(
        F.col("doc_id").alias("id"),
        "text",
        F.when(F.col("lang") != "en", F.concat_ws(",", "source", "lang")).alias("urls"),
        (F.col("doc_id") * 1000).cast("string").alias("timestamp"),
    )
    path = new_run_dir(spark, "lines")
    lines.write.json(path)
    return path
