"""Best-fit packing of tokenised documents, bulk-synchronous.

Tokenising maps every whole text to its ids with a public vocabulary; documents longer than a sequence are cut into full
pieces and a last one. Full pieces are sequences of their own. The others are packed in rounds:

* documents and the gaps of all open sequences are sorted together by size over range partitions, larger first, a gap before a
  document of the same size;
* one sweep over each range gives every document the smallest gap at or above it that no other document has taken; what a range
  leaves over, its documents that found no gap and its gaps that found no document, is numbered by rank and matched
  with the leftovers of the other ranges by rank intervals (one line per range);
* gaps are updated and the next round begins. When few documents find a gap, as many empty sequences are opened as the
  remaining tokens need, and at least one for every document longer than half a sequence.

A gap of at least twice the largest remaining document offers several slots of that size, so short documents do not need a round each.
The rows of a round are written tables. The driver sees two numbers per range and one line per open step.

Defined results: null text is empty and has one piece, the end id. Repeated rows are packed one by one. Extra columns are
ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import json
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicstream.llm.common import text_bytes
from topicstream.session import staged_table


@dataclass(frozen=True)
class Settings:
    capacity: int = 4096
    end_id: int = 1
    rows_per_range: int = 60_000
    few: float = 0.02  # new sequences are opened when a round places a smaller share of the documents
    cached_words: int = 150_000
    cached_length: int = 100  # longer words go through tokenizers


# Words of these characters take the fast way; the vocabulary's own rules for them are plain.
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9\x01]+")
WORD_END, BETWEEN = b"\0", "\1"
SINGLE = 1_000_000  # ranks of lone bytes start here; they never come from a merge


def byte_values() -> dict[str, int]:
    """The characters that stand for the 256 bytes in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class WordIds:
    """Ids of texts from the ids of their words.

    The vocabulary drops white space and merges only inside a word, so the ids of a text are those of its words between
    ASCII blanks, remembered up to a bound. New words of ASCII and Latin-1 letters are merged all at once by
    ``tiktoken`` with the ranks of the same vocabulary, a word's last byte first joined with an end mark; all others go through
    ``tokenizers`` itself. Tests compare both.
    """

    def __init__(self, path: str, settings: Settings):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        value, vocab = byte_values(), model["vocab"]

        def as_bytes(token: str) -> bytes:
            bare = token.removesuffix("</w>")
            return bytes(value[c] for c in bare) + (WORD_END if bare != token else b"")

        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ends = {as_bytes(c + "</w>"): (b, vocab[c + "</w>"]) for c, b in value.items()}
        merged = {as_bytes(x) + as_bytes(y): (256 + i, vocab[x + y]) for i, (x, y) in enumerate(pairs)}
        single = {bytes([b]): (SINGLE + b, vocab.get(c, 0)) for c, b in value.items()}
        known = ends | merged | single
        self.words = tiktoken.Encoding(
            "words", pat_str=r"\x01|[^\x00\x01]+\x00", mergeable_ranks={k: r for k, (r, _) in known.items()}, special_tokens={}
        )
        self.id_of_rank = np.zeros(SINGLE + 256, np.uint32)
        for rank, number in known.values():
            self.id_of_rank[rank] = number
        self.limit, self.length = settings.cached_words, settings.cached_length
        self.reset()

    def reset(self) -> None:
        self.index: dict[bytes, int] = {}
        self.starts, self.sizes, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def new_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of plain words, one after another."""
        marked = PARTS.sub("\\g<0>\0", BETWEEN.join(words).lower())
        ranks = self.words.encode_to_numpy(marked)
        between = np.flatnonzero(ranks == SINGLE + ord(BETWEEN))
        sizes = np.diff(np.concatenate([[-1], between, [len(ranks)]])) - 1
        return sizes, self.id_of_rank[np.delete(ranks, between)]

    def learn(self, words: list[bytes]) -> None:
        text = [w.decode() for w in words]
        plain = [len(w) <= self.length and "<|" not in w and bool(PLAIN.fullmatch(w)) for w in text]
        found = []
        if any(plain):
            found.append(([w for w, p in zip(words, plain, strict=True) if p], *self.new_ids([w for w, p in zip(text, plain, strict=True) if p])))
        if not all(plain):
            rest = [e.ids for e in self.tokenizer.encode_batch([w for w, p in zip(text, plain, strict=True) if not p], add_special_tokens=False)]
            sizes = np.fromiter(map(len, rest), np.int64, len(rest))
            flat = np.fromiter((i for x in rest for i in x), np.uint32, int(sizes.sum()))
            found.append(([w for w, p in zip(words, plain, strict=True) if not p], sizes, flat))
        for group, sizes, flat in found:
            self.index.update(zip(group, range(len(self.sizes), len(self.sizes) + len(group)), strict=True))
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.flat = np.concatenate([self.flat, flat])

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        split = [t.split() for t in texts]
        words = [w for ws in split for w in ws]
        new = list(set(words) - self.index.keys())
        if new:
            self.learn(new)
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.starts[at] - (ends - sizes), sizes) + np.arange(total)]
        bounds = np.concatenate([[0], ends])[np.cumsum([0] + [len(ws) for ws in split])]
        if len(self.index) > self.limit:
            self.reset()
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


@functools.lru_cache(maxsize=1)
def word_ids(path: str, settings: Settings) -> WordIds:
    """One per worker process."""
    return WordIds(path, settings)


def pieces(docs: DataFrame, vocabulary: str, settings: Settings = Settings()) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document."""
    size = settings.capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = word_ids(vocabulary, settings), np.array([settings.end_id], np.uint32)
        for batch in batches:
            texts, at = text_bytes(batch.column("text")), 0
            while at < len(texts):  # a bounded number of bytes at a time
                upto, held = at, 0
                while upto < len(texts) and (upto == at or held + len(texts[upto]) <= 2_000_000):
                    held += len(texts[upto])
                    upto += 1
                rows, number, start, length, crc = [], [], [], [], []
                for row, ids in enumerate(encoder.encode(texts[at:upto]), at):
                    ids = np.concatenate([ids, end]).astype("<u4")
                    for k in range(0, len(ids), size):
                        part = ids[k : k + size]
                        rows.append(row), number.append(k // size), start.append(k), length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                at = upto
                columns = [batch.column("doc_id").take(pa.array(rows)), pa.array(number, pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    columns + [pa.array(x, pa.int64()) for x in (start, length, crc)],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return docs.select("doc_id", "text").mapInArrow(run, ddl)


def sweep_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Match one sorted range: the last free gap seen is the smallest one that holds the next document.

    Gives (range, rank, id, size, bin): matched documents with their bin, leftovers with a rank among their kind and without one (documents
    bin null, gaps id null).
    """
    from pyspark import TaskContext

    number, free, missed = TaskContext.get().partitionId(), [], 0
    names = ["range", "rank", "id", "size", "bin"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        rows = []
        for size, is_doc, key in zip(*(batch.column(c).to_pylist() for c in ("size", "is_doc", "key")), strict=True):
            if not is_doc:
                free.append((size, key))
            elif free:
                rows.append((number, None, key, size, free.pop()[1]))
            else:
                rows.append((number, missed, key, size, None))
                missed += 1
        yield batch_of(rows)
    for at in range(0, len(free), 10_000):
        yield batch_of([(number, at + i, None, size, key) for i, (size, key) in enumerate(free[at : at + 10_000])])


def rank_intervals(counts: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Per range (number, documents left, gaps left), larger sizes first, to (range, first, last, gap range, sum of ranks).

    Document ``first + i`` of a range takes the gap of rank ``sum - (first + i)`` in the gap range.
    """
    free: list[list[int]] = []  # [range, gaps still free]; their ranks are 0 .. n-1
    found = []
    for number, documents, gaps in counts:
        first = 0
        while first < documents and free:
            source, n = free[-1]
            take = min(n, documents - first)
            found.append((number, first, first + take - 1, source, n - 1 + first))
            first += take
            free[-1][1] -= take
            if not free[-1][1]:
                free.pop()
        if gaps:
            free.append([number, gaps])
    return found


def match(docs: DataFrame, bins: DataFrame, largest: int, least: int, rows: int, settings: Settings) -> DataFrame:
    """One sweep over documents (id, length) and gaps (bin, gap): (id, length, bin) of the documents that found one."""
    spark = docs.sparkSession
    slots = F.greatest(F.floor(F.col("gap") / largest) - 1, F.lit(0)).cast("int")  # besides the last one
    sizes = F.concat(F.array_repeat(F.lit(largest), slots), F.array((F.col("gap") - slots * largest).cast("int")))
    gaps = bins.filter(F.col("gap") >= least).select(F.explode(sizes).alias("size"), F.lit(False).alias("is_doc"), F.col("bin").alias("key"))
    both = docs.select(F.col("length").alias("size"), F.lit(True).alias("is_doc"), F.col("id").alias("key")).union(gaps)
    order = [F.desc("size"), F.asc("is_doc"), F.asc("key")]
    ranges = max(1, -(-rows // settings.rows_per_range))
    sorted_rows = both.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    swept = staged_table(sorted_rows.mapInArrow(sweep_range, "range int, rank long, id long, size int, bin long"), "packing-sweep")
    left = swept.filter("rank is not null").groupBy("range").agg(F.count("id").alias("d"), F.count("bin").alias("g"))
    found = rank_intervals(sorted((r["range"], r["d"], r["g"]) for r in left.collect()))
    matched = swept.filter("rank is null").select("id", F.col("size").alias("length"), "bin")
    if not found:
        return matched
    lines = spark.createDataFrame(found, "range int, first long, last long, source int, total long")
    documents = swept.filter("bin is null").join(F.broadcast(lines), "range").filter("rank between first and last")
    documents = documents.select("id", F.col("size").alias("length"), "source", (F.col("total") - F.col("rank")).alias("at"))
    open_gaps = swept.filter("id is null").select(F.col("range").alias("source"), F.col("rank").alias("at"), "bin")
    return matched.union(documents.join(open_gaps, ["source", "at"]).select("id", "length", "bin"))


def pack(lengths: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``lengths``: written table of unique id and length (at most the capacity). Returns id, sequence_id, offset."""
    spark, capacity = lengths.sparkSession, settings.capacity
    full = lengths.filter(F.col("length") == capacity)
    full = full.select("id", (-1 - F.col("id")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    docs = lengths.filter(F.col("length") < capacity).select("id", F.col("length").cast("int").alias("length"))
    sums = [F.count("*"), F.sum("length"), F.max("length"), F.min("length"), F.count_if(F.col("length") > capacity // 2)]
    n, volume, largest, least, long_docs = docs.agg(*sums).head()
    opened, new, bins, n_bins = 0, True, None, 0
    while n:
        if new:
            more = max(1, long_docs, -(-volume // capacity))
            empty = spark.range(opened, opened + more).select(F.col("id").alias("bin"), F.lit(capacity).alias("gap"))
            bins = empty if bins is None else bins.union(empty)
            opened, n_bins = opened + more, n_bins + more
        slots = n_bins + volume // largest
        chosen = match(docs, bins, largest, least, n + slots, settings)
        in_bin = Window.partitionBy("bin").orderBy(F.desc("length"), "id").rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("length").over(in_bin), F.lit(0))
        placed = chosen.join(bins, "bin").withColumn("offset", capacity - F.col("gap") + before)
        placed = staged_table(placed.select("id", "length", "bin", F.col("offset").cast("long")), "packing-placed")
        full = full.union(placed.select("id", F.col("bin").alias("sequence_id"), "offset"))
        docs = staged_table(docs.join(placed.select("id"), "id", "left_anti"), "packing-left")
        taken = placed.groupBy("bin").agg(F.sum("length").cast("int").alias("taken"))
        gap = (F.col("gap") - F.coalesce("taken", F.lit(0))).alias("gap")
        bins = bins.join(taken, "bin", "left").select("bin", gap)
        before_round = n
        n, volume, largest, least, long_docs = docs.agg(*sums).head()
        if n:
            bins = staged_table(bins.filter(F.col("gap") >= least), "packing-gaps")
            n_bins = bins.count()
        new = before_round - n <= settings.few * before_round
    return full


def packed(docs: DataFrame, vocabulary: str, settings: Settings = Settings()) -> DataFrame:
    """All pieces of all documents with their sequence and place: the rows of ``pieces`` plus sequence_id and offset."""
    rows = staged_table(pieces(docs, vocabulary, settings), "packing-pieces")
    rows = staged_table(rows.withColumn("id", F.monotonically_increasing_id()), "packing-numbered")
    return rows.join(pack(rows.select("id", "length"), settings), "id").drop("id")
