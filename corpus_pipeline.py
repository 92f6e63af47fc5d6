"""The corpus pipeline: language ID, quality, near-duplicates, packing; each stage works on what the one before it kept.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of ``docs``; the last one returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicstream.llm import langid, minhash, packing, quality
from topicstream.llm.common import boxed, id_remainder, prepare, table, vocabulary
from topicstream.session import staged_table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no text or no letter) go."""
    prepare(spark)
    rows, restored = boxed(docs, ("doc_id", "text", "lang"))
    net = langid.fit(rows, id_remainder("doc_id", 4) != 2)
    marked = langid.predict(rows, net, rows.columns)
    return marked.filter(F.col("lang_pred") != langid.UNDETERMINED).select(*restored)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of predicted quality 0 go; without any label all stay."""
    prepare(spark)
    rows, restored = boxed(docs, ("doc_id", "text"))
    stats = staged_table(quality.text_statistics(rows, rows.columns), "pipeline-stats")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = quality.fit(stats.select("doc_id", "stats"), labels, id_remainder("doc_id", 3) != 1)
    return quality.predict(stats, model).filter("predicted = 1").select(*restored)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays, that with the smallest id, null ids last; five words, similarity 0.8.

    Rows are named by hashes of id and text, so repeated and null ids are told apart, and one of the rows that repeat both stays.
    """
    prepare(spark)
    rows, restored = boxed(docs, ("doc_id", "text"))
    stay = minhash.marked_rows(rows).filter("kept").select("id_hash", "text_hash")
    named = rows.select("*", *minhash.row_name())
    return named.join(stay, ["id_hash", "text_hash"], "left_semi").dropDuplicates(["id_hash", "text_hash"]).select(*restored)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and place."""
    prepare(spark)
    return packing.packed(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("language ID", language_stage),
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("best-fit packing", packing_stage),
]

ORACLE_SQL = None  # two of the stages are learned models


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a written table, which the next stage reads."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged_table(stage(spark, docs, sf_dir), "pipeline-" + name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
