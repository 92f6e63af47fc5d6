"""Importance resampling towards a target distribution, over hashed runs of words.

An untrained pre-tokeniser (``tokenizers``, Split by a regular expression over the text with A-Z lower-cased) returns the words with their
offsets. The words stand in one buffer, parted by single spaces, and a pair of offsets (start of word i, end of word i + k - 1) is a window on
it: its bytes are the feature, their crc32 the bucket. Two histograms of 10,000 buckets, of the corpus and of the target, give a gain per
bucket; a document's weight is the sum of the gains of its features. Adding Gumbel noise from a keyed hash of the id to the
weights and keeping the highest ones draws documents without replacement in proportion to the exponential of their weights.

The texts are read once: the buckets of every document are a written table of two bytes a feature. Histograms are summed in each task
before they are shuffled, at most one row per bucket and task. The driver sees one number per bucket. Ranks come from ranges of the order, shifted by
the sizes of the ranges before them.

Defined results: null and empty texts have no words, no features and weight 0. Texts of any length are tokenised whole, in pieces of
bounded size with two words carried over. A null id is hashed as the empty text and sorts behind all others among equal scores; rows equal in
all columns take neighbouring ranks in any order. Repeated rows count once each. An empty corpus gives an empty table, an empty target
T = 0 and t = 0. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicstream.llm.common import lowered_pieces, map_batches, text_bytes
from topicstream.session import staged_table

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Settings:
    buckets: int = 10_000
    longest: int = 3  # words in a feature
    least_words: int = 20  # shorter documents are not drawn
    percent: int = 5
    scale: int = 1000  # gains and scores are whole thousandths
    seed: int = 42
    piece: int = 262_144  # bytes of text tokenised at a time


@lru_cache(maxsize=1)
def splitter():
    """The pre-tokeniser; words are what the pattern matches, everything else is removed."""
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(WORD), "removed", invert=True)


def words_with_offsets(text: bytes) -> tuple[list[str], np.ndarray]:
    """Words of a lower-cased text and their (start, end) in bytes.

    Every byte is one character here. Bytes of characters beyond ASCII are 80 and above, like the characters they become, so the words
    are the same ones.
    """
    pairs = splitter().pre_tokenize_str(text.decode("latin-1"))
    return [w for w, _ in pairs], np.array([span for _, span in pairs], np.int64).reshape(-1, 2)


def bucket_windows(text: bytes, settings: Settings = Settings()) -> Iterator[tuple[int, list[int]]]:
    """Per piece of the text: its number of words, and the buckets of all windows that end in it."""
    held: list[str] = []
    for piece in lowered_pieces(text, settings.piece):
        words, offsets = words_with_offsets(piece)
        fresh, carried = len(words), len(held)
        widths = np.concatenate([np.array([len(w) for w in held], np.int64), offsets[:, 1] - offsets[:, 0]])
        held += words
        buffer = " ".join(held).encode("latin-1")
        ends = np.cumsum(widths + 1) - 1
        starts, ends = (ends - widths).tolist(), ends.tolist()
        found: list[int] = []
        for size in range(1, settings.longest + 1):
            first = max(0, carried - size + 1)  # windows before it ended in an earlier piece
            found += [crc32(buffer[a:b]) % settings.buckets for a, b in zip(starts[first:], ends[first + size - 1 :], strict=False)]
        yield fresh, found
        held = held[max(0, len(held) - settings.longest + 1) :]


def bucketed(texts: DataFrame, settings: Settings, keep: tuple[str, ...] = ()) -> DataFrame:
    """``texts`` (text and the columns to keep) to those columns, n_words, n_features and the buckets as packed numbers."""
    kind = np.min_scalar_type(settings.buckets - 1)

    def transform(batch: pa.RecordBatch) -> dict:
        words, features, packed = [], [], []
        for text in text_bytes(batch.column("text")):
            pieces = [(n, np.array(b, kind)) for n, b in bucket_windows(text, settings)]
            words.append(sum(n for n, _ in pieces))
            features.append(sum(len(b) for _, b in pieces))
            packed.append(b"".join(b.tobytes() for _, b in pieces))
        return {c: batch.column(c) for c in keep} | {"n_words": words, "n_features": features, "buckets": packed}

    kept = "".join(f"{c} {texts.schema[c].dataType.simpleString()}, " for c in keep)
    return map_batches(texts.select(*keep, "text"), transform, f"{kept}n_words long, n_features long, buckets binary")


def histogram(marked: DataFrame, settings: Settings) -> np.ndarray:
    """Features per bucket over all rows."""
    kind, buckets = np.min_scalar_type(settings.buckets - 1), settings.buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch.column("buckets").to_pylist():
                total += np.bincount(np.frombuffer(packed, kind), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    parts = marked.select("buckets").mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray, scale: int) -> np.ndarray:
    """Whole thousandths of the log ratio of the smoothed shares, per bucket."""
    size, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    ratio = [(t + 1.0) * (s_all + size) / ((s + 1.0) * (t_all + size)) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(scale * math.log(r)) for r in ratio], np.int64)


def noise(name: str, settings: Settings) -> int:
    """Gumbel noise of a document, from its id."""
    h = int(hashlib.sha256(f"{settings.seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-settings.scale * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(marked: DataFrame, gain: np.ndarray, settings: Settings) -> DataFrame:
    kind = np.min_scalar_type(settings.buckets - 1)

    def transform(batch: pa.RecordBatch) -> dict:
        weight = [int(gain[np.frombuffer(b, kind)].sum()) for b in batch.column("buckets").to_pylist()]
        drawn = [noise(n or "", settings) for n in batch.column("name").to_pylist()]
        kept = {c: batch.column(c) for c in ("doc_id", "row", "n_words", "n_features")}
        return kept | {"weight": weight, "score": [a + b for a, b in zip(weight, drawn, strict=True)]}

    named = marked.withColumn("name", F.col("doc_id").cast("string"))
    key = marked.schema["doc_id"].dataType.simpleString()
    return map_batches(named, transform, f"doc_id {key}, row long, n_words long, n_features long, weight long, score long")


def ranked(rows: DataFrame, order: list[Column], last: int) -> DataFrame:
    """Adds ``rank``, 1 for the first row in the order; null beyond ``last``.

    Ranges of the order are sorted on their own. A row's number within its task gives its place in the range, which is shifted by the sizes of the
    ranges before. ``order`` should not leave ties.
    """
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ranges = staged_table(sorted_rows, "resample-ranges")
    ranges = ranges.withColumn("_range", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND((1 << 33) - 1))
    sizes = ranges.groupBy("_range").agg(F.count("*").alias("n"))  # one row per task of the sort
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_shift"))
    place = F.col("_shift") + F.col("_at") + 1
    return ranges.join(F.broadcast(shift), "_range").select(*rows.columns, F.when(place <= last, place).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` (doc_id, text) drawn towards ``target`` (text): doc_id, n_features, weight, score, rank, one row per document."""
    numbered = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    marked = staged_table(bucketed(numbered, settings, ("doc_id", "row")), "resample-buckets")
    aimed = histogram(bucketed(target, settings), settings)
    gain = gains(histogram(marked, settings), aimed, settings.scale)
    rows = staged_table(scored(marked, gain, settings), "resample-scores")
    eligible = F.col("n_words") >= settings.least_words
    last = settings.percent * rows.filter(eligible).count() // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc(), F.col("weight").asc(), F.col("row").asc()]
    drawn = ranked(rows.filter(eligible), order, last)
    out = drawn.unionByName(rows.filter(~eligible).withColumn("rank", F.lit(None).cast("long")))
    return out.select("doc_id", "n_features", "weight", "score", "rank")
