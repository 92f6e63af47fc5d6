"""One registered query per training-data operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicstream.llm import bloom_lm, html_text, langid, lloyd, minhash, packing, pieces, pq, quality, resample, spotsigs, warc, winnow
from topicstream.llm.common import id_remainder, prepare, table, vocabulary
from topicstream.session import staged_table

QUERIES = {}


def query(fn):
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)

    prepared.__name__, prepared.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = prepared
    return prepared


@query
def op1_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to dictionary-compressed archives and read back."""
    records = warc.read_archives(warc.write_archives(table(spark, sf_dir, "pages")), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op2_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with merge-dropout and decoded again."""
    return pieces.round_trip(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query
def op3_product_quantised_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate embeddings within a label, cosine 0.98 or more."""
    return pq.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate documents by two-word shingles."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), minhash.Settings(shingle=2))


@query
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality, learned from labelled rows with crc32(doc_id) mod 3 other than 1."""
    held_out = id_remainder("doc_id", 3) == 1
    stats = staged_table(quality.text_statistics(table(spark, sf_dir, "documents"), ["doc_id"]), "quality-stats")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = quality.fit(stats, labels, ~held_out)
    return quality.predict(stats.withColumn("held_out", held_out), model)


@query
def op6_line_block_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op7_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint against its edited text and the next document."""
    return spotsigs.compared(table(spark, sf_dir, "documents"))


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned from rows with crc32(doc_id) mod 4 other than 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = id_remainder("doc_id", 4) == 2
    net = langid.fit(docs, ~held_out)
    return langid.predict(docs.withColumn("held_out", held_out), net, ["doc_id", "held_out"])


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 tokens."""
    return packing.packed(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query
def op10_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log probability, learned from rows with crc32(doc_id) mod 5 other than 1."""
    held_out = id_remainder("doc_id", 5) == 1
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out.alias("held_out"))
    model = bloom_lm.fit(docs, ~F.col("held_out"))
    return bloom_lm.score(docs, model, ["doc_id", "held_out"])


@query
def op11_member_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings after four Lloyd rounds over members that stay with their entry."""
    return lloyd.compress(table(spark, sf_dir, "embeddings"))


@query
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight and score towards the benchmark texts, and the rank of those drawn."""
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words inside runs it shares with benchmark items."""
    return winnow.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
