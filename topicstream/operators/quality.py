"""Scores of the clusters of one batch, or of many batches at once.

All reports take assigned posts: (id, cluster_id, text, urls, own, other) plus any further key columns.
``own`` and ``other`` are the scaled distances to the own and to the neighboring center.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicstream.functions.vectors import round2, safe_ratio, scaled_dist
from topicstream.operators.nearest import nearest_neighbor_center, predict, small_model

KEYS = ("cluster_id",)


def neighbor_centers(model: DataFrame, blocks: list | None = None) -> DataFrame:
    """(cluster_id, neighbor_id, neighbor_center) by a join of the model with itself."""
    pairs = nearest_neighbor_center(model, blocks=blocks).select("cluster_id", "neighbor_id")
    other = model.select(F.col("cluster_id").alias("neighbor_id"), F.col("center").alias("neighbor_center"))
    return pairs.join(other, "neighbor_id").select("cluster_id", "neighbor_id", "neighbor_center")


def assign(features: DataFrame, model: DataFrame, vector: str = "tfidf") -> DataFrame:
    """Nearest cluster of every post, with the scaled distances to it and to its neighbor.

    Text and links ride along, so no join by post id is needed. Posts without a positive vector sum
    have no cluster; they are returned with nulls.
    """
    blocks = small_model(model)
    hits = predict(features, model, vector, blocks=blocks)
    live = F.col("vec_sum") > 0
    hits = hits.withColumn("cluster_id", F.when(live, F.col("cluster_id")))
    hits = hits.withColumn("own", F.when(live, F.col("sq_dist") / F.col("vec_sum")))
    joined = hits.join(neighbor_centers(model, blocks), "cluster_id", "left")
    other = scaled_dist(F.col(vector), F.col("neighbor_center"), F.col("vec_sum"))
    return joined.withColumn("other", other).drop("neighbor_center", "sq_dist")


def used_clusters(assigned: DataFrame) -> DataFrame:
    return assigned.filter(F.col("cluster_id").isNotNull()).select("cluster_id").distinct()


def representative(assigned: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The post closest to the center; the lowest id wins a tie.

    Three hash aggregations and joins on numbers instead of one aggregation over texts, which Spark
    could only run by sorting every cluster.
    """
    keys = list(keys)
    rows = assigned.filter(F.col("cluster_id").isNotNull())
    best = rows.groupBy(*keys).agg(F.min("own").alias("best"))
    closest = rows.select(*keys, "id", "own").join(best, keys).filter(F.col("own") == F.col("best"))
    first = closest.groupBy(*keys).agg(F.min("id").alias("id"))
    return rows.select(*keys, "id", "text").join(first, [*keys, "id"]).select(
        *keys, F.col("id").alias("rep_id"), F.col("text").alias("rep_text")
    )


def best_url(assigned: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The most frequent link per cluster, the greatest one in a tie, 'none' without any."""
    keys = list(keys)
    counts = (
        assigned.select(*keys, F.explode_outer("urls").alias("url"))
        .groupBy(*keys, "url")
        .agg(F.count("url").alias("n"))
    )
    return counts.groupBy(*keys).agg(
        F.coalesce(F.max_by("url", F.struct("n", "url")), F.lit("none")).alias("best_url")
    )


def interesting_flag(count, silhouette):
    """At least 8 posts and an unrounded silhouette between 0.4 and 0.95."""
    return (count >= 8) & (silhouette >= 0.4) & (silhouette <= 0.95)


def cluster_scores(assigned: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Count, mean distances and silhouette per cluster, not yet rounded."""
    rows = assigned.filter(F.col("cluster_id").isNotNull())
    scores = rows.groupBy(*keys).agg(
        F.count("*").alias("count"), F.avg("own").alias("intra"), F.avg("other").alias("inter")
    )
    silhouette = safe_ratio(F.col("inter") - F.col("intra"), F.greatest("inter", "intra"))
    return scores.withColumn("silhouette", silhouette)


def cluster_quality(assigned: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The cluster report: scores, flag, representative post and most shared link."""
    keys = list(keys)
    return (
        cluster_scores(assigned, keys)
        .withColumn("interesting", interesting_flag(F.col("count"), F.col("silhouette")))
        .join(representative(assigned, keys), keys, "left")
        .join(best_url(assigned.filter(F.col("cluster_id").isNotNull()), keys), keys, "left")
        .select(
            *keys,
            "count",
            round2(F.col("silhouette")).alias("silhouette"),
            round2(F.col("intra")).alias("intra"),
            round2(F.col("inter")).alias("inter"),
            "interesting",
            "rep_id",
            "rep_text",
            "best_url",
        )
    )


def rank_by_silhouette(report: DataFrame) -> DataFrame:
    return report.orderBy(F.desc("silhouette"), "cluster_id")


def batch_summary(report: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Posts, clusters, interesting clusters and the count-weighted mean of the rounded silhouettes."""
    total = F.sum("count")
    return report.groupBy(*keys).agg(
        total.alias("posts"),
        F.count("*").alias("clusters"),
        F.sum(F.col("interesting").cast("long")).alias("interesting"),
        (F.sum(F.col("count") * F.col("silhouette")) / total).alias("avg_silhouette"),
    )
