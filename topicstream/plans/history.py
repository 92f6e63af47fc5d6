"""Merged results over all batches, and the cluster-by-batch history built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicstream.operators.features import filter_collisions, merge_buckets
from topicstream.schemas import CLUSTER_INFO

INFO = [c.split()[0] for c in CLUSTER_INFO.split(", ")]


def merge_cluster_info(info: DataFrame) -> DataFrame:
    return info.select("batch_id", *INFO).orderBy("batch_id", "cluster_id")


def merge_assignments(assigned: DataFrame) -> DataFrame:
    """Clustered posts in (batch, cluster) order. Sorted by range, so a large batch spans many tasks."""
    rows = assigned.filter(F.col("cluster_id").isNotNull()).select("batch_id", "cluster_id", "id", "text")
    return rows.orderBy("batch_id", "cluster_id", "id")


def merge_collisions(collisions: DataFrame) -> DataFrame:
    return filter_collisions(merge_buckets(collisions)).orderBy("bucket", "word")


def batch_index(df: DataFrame) -> DataFrame:
    """(batch_id, batch_index): a dense number per batch, ranked on the short list of batch ids."""
    rank = F.dense_rank().over(Window.orderBy("batch_id")) - 1
    return df.select("batch_id").distinct().select("batch_id", rank.cast("long").alias("batch_index"))


def interesting_history(info: DataFrame) -> DataFrame:
    """All rows of the clusters that were interesting in at least one batch."""
    keep = info.filter("interesting").select("cluster_id").distinct()
    return info.join(keep, "cluster_id", "left_semi")


def history_grid(info: DataFrame) -> DataFrame:
    """One cell per interesting cluster and batch, with count 0 where the cluster had no post."""
    numbers = batch_index(info)
    history = interesting_history(info).join(numbers, "batch_id").drop("batch_id")
    last = numbers.agg(F.max("batch_index").alias("last"))
    cells = history.select("cluster_id").distinct()
    cells = cells.select("cluster_id", F.explode(F.sequence(F.lit(0).cast("long"), last.scalar())).alias("batch_index"))
    return cells.join(history, ["cluster_id", "batch_index"], "left").withColumn(
        "count", F.coalesce("count", F.lit(0).cast("long"))
    )


def group_by_cluster(grid: DataFrame) -> DataFrame:
    """One row per cluster with its cells in batch order; a list holds at most one cell per batch."""
    cell = F.struct("batch_index", "count", "silhouette", "interesting", "rep_id", "best_url")
    return grid.groupBy("cluster_id").agg(F.array_sort(F.collect_list(cell)).alias("cells"))


def with_post_link(info: DataFrame, prefix: str) -> DataFrame:
    return info.withColumn("rep_link", F.concat(F.lit(prefix), F.col("rep_id").cast("string")))


def drilldown(assigned: DataFrame, cluster_id: int, batch_number: int, batches: DataFrame | None = None) -> DataFrame:
    """The posts of one cell of the grid. ``batch_id`` is a partition column, so other batches are not read.

    ``batches`` is any table with all batch ids; the batch summary has one row for each.
    """
    numbers = batch_index(assigned if batches is None else batches)
    wanted = numbers.filter(F.col("batch_index") == batch_number).select("batch_id")  # one row
    rows = assigned.filter(F.col("cluster_id") == cluster_id)
    return rows.join(F.broadcast(wanted), "batch_id", "left_semi").select("batch_id", "cluster_id", "id", "text")
