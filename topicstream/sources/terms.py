"""Tracking terms: word lists from files and the filter that uses them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicstream.functions.text import tokenize
from topicstream.session import staged_table


def term_union(domains: DataFrame, keywords: DataFrame, outlets: DataFrame) -> DataFrame:
    """One list of distinct terms; of an outlet line 'Name - @Handle' only the handle counts."""
    handles = outlets.select(F.substring_index("value", "@", -1).alias("value"))
    terms = domains.select("value").unionByName(keywords.select("value")).unionByName(handles)
    return terms.select(F.trim("value").alias("term")).filter(F.col("term") != "").distinct()


def read_terms(spark: SparkSession, domains: str, keywords: str, outlets: str) -> DataFrame:
    return term_union(spark.read.text(domains), spark.read.text(keywords), spark.read.text(outlets))


def phrase_words(terms: DataFrame) -> DataFrame:
    """(phrase, words): the distinct words of every term, each set of words once; ``phrase`` is its digest."""
    words = F.array_sort(F.array_distinct(F.filter(F.split(F.lower("term"), r"\s+"), lambda w: w != "")))
    sets = terms.select(words.alias("words")).filter(F.size("words") > 0)
    return sets.select(F.md5(F.array_join("words", " ").cast("binary")).alias("phrase"), "words").dropDuplicates(["phrase"])


def track_filter(posts: DataFrame, terms: DataFrame, text: str = "text") -> DataFrame:
    """Posts that contain all words of at least one row of ``terms`` (term).

    The terms are a table of any length. Every phrase waits under its rarest word, as counted over the distinct texts; a text that has
    that word must then have as many of the phrase's words as the phrase has. So frequent words are looked up for the few texts that
    could still match, and copies of a text are looked up once. A post without text contains no term.
    """
    keyed = posts.withColumn("_text", F.md5(F.col(text).cast("binary")))
    phrases = staged_table(phrase_words(terms), "phrases")
    listed = phrases.select("phrase", F.explode("words").alias("word"))
    tracked = listed.select("word").distinct()
    texts = keyed.filter(F.col(text).isNotNull()).select("_text", F.explode(F.array_distinct(tokenize(F.col(text)))).alias("word"))
    found = staged_table(texts.join(tracked, "word", "left_semi").distinct(), "tracked-words")
    counts = found.groupBy("word").agg(F.count("*").alias("n"))
    rarest = listed.join(counts, "word").groupBy("phrase").agg(F.min_by("word", F.struct("n", "word")).alias("word"), F.count("*").alias("known"))
    waiting = phrases.join(rarest, "phrase").filter(F.col("known") == F.size("words"))
    waiting = waiting.select("word", "phrase", F.filter("words", lambda w: w != F.col("word")).alias("rest"))
    met = staged_table(found.join(waiting, "word").select("_text", "phrase", "rest"), "phrases-met")
    whole = met.filter(F.size("rest") == 0).select("_text")
    asked = met.select("_text", "phrase", F.size("rest").alias("n"), F.explode("rest").alias("word"))
    seen = asked.join(found, ["_text", "word"]).groupBy("_text", "phrase").agg(F.count("*").alias("seen"), F.max("n").alias("n"))
    matched = whole.union(seen.filter(F.col("seen") == F.col("n")).select("_text")).distinct()
    return keyed.join(matched, "_text", "left_semi").select(*posts.columns)
