"""Per-batch hashed TF-IDF features and the hash-collision report.

A post is one row, so its term counts are formed inside the row (no shuffle). Fitting the inverse
document frequency is one tree aggregation over ``dims`` counters.
"""

from __future__ import annotations

from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicstream.functions.text import bucket_counts, hash_bucket, post_tokens, token_hash_buckets
from topicstream.functions.vectors import vector_sum
from topicstream.session import staged_table


def clean_tokens(posts: DataFrame, text: str = "text") -> DataFrame:
    return posts.withColumn("tokens", post_tokens(F.col(text)))


def term_vectors(posts: DataFrame, dims: int = 100, method: str = "string_hash") -> DataFrame:
    """Adds ``tf``, the vector of term counts per hash bucket, to rows with ``tokens``."""
    if method == "murmur3":
        return HashingTF(numFeatures=dims, inputCol="tokens", outputCol="tf").transform(posts)
    return posts.withColumn("tf", array_to_vector(bucket_counts(F.col("tokens"), dims)))


def weight_vectors(counted: DataFrame) -> DataFrame:
    """Adds ``tfidf`` and its component sum; idf = ln((posts + 1) / (posts with term + 1)).

    The fit scans ``counted`` once before the result scans it again: persist it when it is costly.
    """
    model = IDF(inputCol="tf", outputCol="_weighted").fit(counted)
    return (
        model.transform(counted)
        .withColumn("tfidf", vector_to_array("_weighted"))
        .drop("_weighted", "tf")
        .withColumn("vec_sum", vector_sum(F.col("tfidf")))
    )


def preprocess(posts: DataFrame, dims: int = 100, method: str = "string_hash", keep_text: bool = False) -> DataFrame:
    """The whole text pipeline over stored posts: hashed term counts, TF-IDF vector and its sum.

    The counts are needed twice, for the fit and for the result. They are staged as a table in between, since
    reading them costs far less than cleaning all texts again.
    """
    keep = [c for c in posts.columns if keep_text or c != "text"]
    counted = term_vectors(clean_tokens(posts), dims, method).select(*keep, "tf")
    return weight_vectors(staged_table(counted, "term-counts"))


def _entries(df: DataFrame, vector: str, value: str) -> DataFrame:
    return df.select("id", F.posexplode(vector).alias("bucket", value)).filter(F.col(value) > 0)


def term_frequency(posts: DataFrame, dims: int = 100) -> DataFrame:
    """(id, bucket, n) for posts with ``id`` and ``text``."""
    counted = term_vectors(clean_tokens(posts), dims)
    counted = counted.select("id", vector_to_array("tf").alias("tf"))
    return _entries(counted, "tf", "n").withColumn("n", F.col("n").cast("long"))


def idf_weight(posts: DataFrame, dims: int = 100) -> DataFrame:
    """(id, bucket, w) with the weights that are not zero."""
    return _entries(preprocess(posts, dims), "tfidf", "w")


def token_buckets(cleaned: DataFrame, dims: int = 100) -> DataFrame:
    """One row per token: the input's ``id`` and other columns, ``word`` and ``bucket``."""
    pairs = F.arrays_zip(F.col("tokens").alias("word"), token_hash_buckets(F.col("tokens"), dims).alias("bucket"))
    return cleaned.select("*", F.inline(pairs)).drop("tokens")


def collision_map(cleaned: DataFrame, dims: int = 100) -> DataFrame:
    """Per post and bucket the distinct words; the lists are bounded by the post's own text."""
    rows = token_buckets(cleaned.select("id", "tokens"), dims)
    return rows.groupBy("id", "bucket").agg(F.array_sort(F.collect_set("word")).alias("words"))


def bucket_words(cleaned: DataFrame, dims: int = 100) -> DataFrame:
    """Distinct (bucket, word). Words are made distinct before they are hashed and shuffled."""
    words = cleaned.select(F.explode(F.array_distinct("tokens")).alias("word")).distinct()
    return words.select(hash_bucket(F.col("word"), dims).alias("bucket"), "word")


def merge_buckets(words: DataFrame) -> DataFrame:
    """Distinct words per bucket over any number of batches, with the bucket's word count.

    Kept as rows: with few buckets and a large vocabulary a word list would be a single huge value.
    """
    distinct = words.select("bucket", "word").distinct()
    sizes = distinct.groupBy("bucket").agg(F.count("*").alias("n_words"))
    return distinct.join(sizes, "bucket").select("bucket", "word", "n_words")


def filter_collisions(merged: DataFrame) -> DataFrame:
    return merged.filter(F.col("n_words") > 1)


def collision_report(posts: DataFrame, dims: int = 100) -> DataFrame:
    """Words that share a bucket, sorted by bucket."""
    words = bucket_words(clean_tokens(posts), dims)
    return filter_collisions(merge_buckets(words)).orderBy("bucket", "word")
