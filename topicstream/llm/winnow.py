"""Benchmark decontamination by winnowing.

A text is its sequence of words. Of every window of ``span`` words the smallest hash of its ``gram``-word runs is kept as the
window's fingerprint. A run of words that two texts share holds the same windows in both, so every shared run of ``span`` words or more has at
least one fingerprint in common, wherever it stands. An item shorter than a window is one window of its own length, and documents are
read at each such length too.

Fingerprints of documents meet those of the items in two steps. A bitmap of the items' fingerprints and one of their whole windows, of a
bounded size whatever the benchmark's, go to the tasks; only windows found in both leave the pass over the texts. They are then joined with the
items' windows by length, fingerprint and window hash, 128 bits beside the length. Each row of documents meets one row at most, so a frequent run of
words does not pair all its places in documents with all its places in items. Joined windows are extended into the runs they cover: overlapping and
adjoining ones are united and their words counted once. Items with equal words are one class until their ids are listed.

Defined results: null, empty and wordless texts have no words and hit nothing; such items have no window. Texts of any length are read whole,
hashed in pieces and compared in blocks of bounded size. Rows are told apart by a number of their own, so repeated and null doc_ids keep
their own results. Rows that share an item_id are one item; a null item_id counts as an item whose id is the empty text. A document without hits has the
digest of the empty list. Empty tables of documents give no rows; an empty benchmark hits nothing. Extra columns are ignored. Two different
words are confused if their 64-bit hashes agree: for ten million distinct words a chance of 3e-6 that any two do.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicstream.llm.common import TO_SPACE, bitmap, bitmap_size, in_bitmap, lowered_pieces, mix64, text_bytes
from topicstream.session import staged_table


@dataclass(frozen=True)
class Settings:
    span: int = 10  # words of a window
    gram: int = 4  # words of a fingerprinted run
    bits_per_window: int = 64  # of each bitmap
    most_bits: int = 1 << 27  # bound of each bitmap: 16 MB
    piece: int = 1 << 20  # bytes of text split at a time
    block: int = 1 << 19  # words compared at a time
    cached_words: int = 200_000


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def word_hashes(text: bytes, hashes: WordHashes, settings: Settings) -> np.ndarray:
    parts = []
    for piece in lowered_pieces(text, settings.piece):
        words = piece.translate(TO_SPACE).split()
        parts.append(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)))
        if len(hashes) > settings.cached_words:
            hashes.clear()
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def runs(h: np.ndarray, at: np.ndarray | slice, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words that begin at the places ``at`` (a slice: all places it names)."""
    take = (lambda i: h[at.start + i : at.stop + i]) if isinstance(at, slice) else (lambda i: h[at + i])
    total = mix64(take(0) + np.uint64(size))
    for i in range(1, size):
        total = mix64(total + take(i))
    return total


def fingerprints(h: np.ndarray, size: int, gram: int) -> np.ndarray:
    """The smallest hash among the runs of ``gram`` words inside each window of ``size`` words."""
    grams = runs(h, slice(0, len(h) - gram + 1), gram)
    least = grams[: len(h) - size + 1].copy()
    for i in range(1, size - gram + 1):
        np.minimum(least, grams[i : len(least) + i], out=least)
    return least


def windows(h: np.ndarray, text: np.ndarray, size: int, settings: Settings, sieve=None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places, fingerprints and hashes of the windows of ``size`` words that lie in one text; ``text`` numbers the text of each word.

    ``sieve`` holds the bitmaps of fingerprints and windows; without it all windows are given.
    """
    for lo in range(0, len(h) - size + 1, settings.block):
        part, name = h[lo : lo + settings.block + size - 1], text[lo : lo + settings.block + size - 1]
        least = fingerprints(part, size, min(size, settings.gram))
        good = name[: len(least)] == name[size - 1 :]
        if sieve:
            good &= in_bitmap(sieve[0], least)
        at = np.flatnonzero(good)
        whole = runs(part, at, size)
        if sieve:
            found = in_bitmap(sieve[1], whole)
            at, whole = at[found], whole[found]
        yield at + lo, least[at], whole


def numbered_words(texts: list[bytes], hashes: WordHashes, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words, the number of the text of each, and the words per text."""
    parts = [word_hashes(t, hashes, settings) for t in texts]
    sizes = np.array([len(p) for p in parts], np.int64)
    return np.concatenate(parts), np.repeat(np.arange(len(parts)), sizes), sizes


def bounded(batches: Iterator[pa.RecordBatch], most: int = 4_000_000) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The batches in slices of a bounded number of text bytes, or of one text."""
    for batch in batches:
        texts, at = text_bytes(batch.column("text")), 0
        while at < len(texts):
            upto, held = at, 0
            while upto < len(texts) and (upto == at or held + len(texts[upto]) <= most):
                held += len(texts[upto])
                upto += 1
            yield batch.slice(at, upto - at), texts[at:upto]
            at = upto


def item_windows(items: DataFrame, settings: Settings) -> DataFrame:
    """``items`` (item, text) to item, class (digest of its words), size, fp, win: one row per window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch, texts in bounded(batches):
            names = batch.column("item").to_pylist()
            for name, text in zip(names, texts, strict=True):
                h = word_hashes(text, hashes, settings)
                size = min(settings.span, len(h))
                if not size:
                    continue
                kind = xxhash.xxh3_128_hexdigest(h.tobytes())
                for _, fp, win in windows(h, np.zeros(len(h), np.int64), size, settings):
                    n = len(fp)
                    columns = [[name] * n, [kind] * n, np.full(n, size), fp.view(np.int64), win.view(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["item", "class", "size", "fp", "win"])

    kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
    return items.mapInArrow(run, "item string, class string, size int, fp long, win long")


def sifted(docs: DataFrame, sizes: list[int], sieve, settings: Settings) -> DataFrame:
    """``docs`` (doc_id, row, text) to doc_id, row, n_words and lists at, size, fp, win of the windows found in both bitmaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, maps = WordHashes(), sieve.value
        for batch, texts in bounded(batches):
            h, name, counts = numbered_words(texts, hashes, settings)
            found = [(at, np.full(len(at), size), fp, win) for size in sizes for at, fp, win in windows(h, name, size, settings, maps)]
            found = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.empty(0, np.int64)] * 2 + [np.empty(0, np.uint64)] * 2
            owner = name[found[0]]
            turn = np.argsort(owner, kind="stable")
            found, owner = [x[turn] for x in found], owner[turn]
            found[0] = found[0] - (np.cumsum(counts) - counts)[owner]
            offsets = pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x.view(np.int64) if x.dtype == np.uint64 else x, t)) for x, t in zip(found, kinds, strict=True)]
            columns = [batch.column("doc_id"), batch.column("row"), pa.array(counts, pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "n_words", "at", "size", "fp", "win"])

    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "row", "text").mapInArrow(run, f"doc_id {key}, row long, n_words long, at array<long>, size array<int>, fp array<long>, win array<long>")


def hits(docs: DataFrame, items: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents (doc_id, row, n_words), spans of hit windows (row, from, to), and items found (row, item), the latter two distinct."""
    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    listed = staged_table(item_windows(named, settings), "winnow-items")
    keys = ["size", "fp", "win"]
    of_class = staged_table(listed.select("class", *keys).distinct(), "winnow-windows")
    distinct = of_class.select(*keys).distinct()
    sizes = sorted(r["size"] for r in distinct.select("size").distinct().collect())  # at most ``span`` numbers
    bits = bitmap_size(distinct.count(), settings.bits_per_window, settings.most_bits)
    sieve = docs.sparkSession.sparkContext.broadcast((bitmap(distinct, "fp", bits), bitmap(distinct, "win", bits)))
    numbered = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    marked = staged_table(sifted(numbered, sizes, sieve, settings), "winnow-documents")

    each = F.explode(F.arrays_zip("at", "size", "fp", "win")).alias("w")
    places = marked.filter(F.size("at") > 0).select("row", each).select("row", "w.*")
    found = staged_table(places.join(distinct, keys).select("row", "at", *keys), "winnow-hits")
    spans = found.select("row", F.col("at").alias("from"), (F.col("at") + F.col("size")).alias("to")).distinct()
    classes = found.select("row", *keys).distinct().join(of_class, keys).select("row", "class").distinct()
    listed = classes.join(listed.select("class", "item").distinct(), "class").select("row", "item").distinct()
    return marked.select("doc_id", "row", "n_words"), spans, listed


def decontaminate(docs: DataFrame, items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` (doc_id, text) against ``items`` (item_id, text): doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    rows, spans, listed = hits(docs, items, settings)
    ordered = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("from", "to"))).alias("s"))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    add = lambda acc, s: F.struct(  # noqa: E731 - words beyond those counted so far
        (acc["n"] + F.greatest(s["to"] - F.greatest(s["from"], acc["upto"]), F.lit(0))).alias("n"), F.greatest(acc["upto"], s["to"]).alias("upto")
    )
    counted = ordered.select("row", F.aggregate("s", start, add)["n"].alias("n_hit"))
    names = listed.groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("names"))
    out = rows.join(counted, "row", "left").join(names, "row", "left")
    joined = F.coalesce(F.array_join("names", ","), F.lit(""))
    n_hit = F.coalesce("n_hit", F.lit(0))
    return out.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("names"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(joined.cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )
