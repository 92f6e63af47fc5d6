"""Batch outputs: one partition folder per batch and table, all keyed by the same batch id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("cluster_info", "assignments", "collisions", "batch_summary")


def write_batch(df: DataFrame, root: str, table: str, batch_id: int) -> None:
    """Replace the partition of one batch, so that a batch that runs twice is stored once."""
    df.write.mode("overwrite").parquet(f"{root}/{table}/batch_id={batch_id}")


def read_batches(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All batches of a table; a filter on ``batch_id`` reads only the folders it names."""
    df = spark.read.parquet(f"{root}/{table}")
    return df.withColumn("batch_id", df["batch_id"].cast("long"))


def read_batch(spark: SparkSession, root: str, table: str, batch_id: int) -> DataFrame:
    return spark.read.parquet(f"{root}/{table}/batch_id={batch_id}")


def write_posts(posts: DataFrame, root: str, batch_id: int) -> None:
    """Collected posts as table rows and as JSON lines."""
    write_batch(posts, root, "posts", batch_id)
    posts.write.mode("overwrite").json(f"{root}/post_lines/batch_id={batch_id}")


def merge_sink(merged: DataFrame, root: str, table: str) -> DataFrame:
    """Replace a merged result and return what was stored."""
    path = f"{root}/merged_{table}"
    merged.write.mode("overwrite").parquet(path)
    return merged.sparkSession.read.parquet(path)
