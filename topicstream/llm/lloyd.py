"""Vector codes by member-resident Lloyd rounds.

Components become whole numbers, vectors are cut into equal parts, and each part position has a codebook. The parts live in partitions by owner, which is
(position, entry, salt): an entry with many members has as many owners as it needs, so none holds much more than ``members`` parts. A round
needs two things from the members that are already there: owners add up their parts, which gives the new codebooks, and then look for the
nearest entry of each. A part that keeps its entry stays where it is. Only parts that change it are sent to an owner of the new entry, by a shuffle
into the partitioning the others already have, and the union of both needs no further exchange.

The driver sees codebooks and counts only, numbers whose size is set by entries and vector length. Every round is a reliable checkpoint; a lost
executor costs one round at most.

All arithmetic is on whole numbers. While four times a part's length times the square of the largest component stays below 2^53, products of doubles
are exact and do the distances; beyond, Python's unbounded integers do, slower and with the same result.

Defined results: rows whose vector is null or holds null or non-finite components are dropped. Vectors shorter than the longest one, or than the next multiple of
the parts, count as filled up with zeros. The codebooks start with rows in the order of vec_id, null ids last, ties by the vector; with fewer rows than
entries they have as many entries as rows. Rows that repeat an id or a whole row are rows of their own. Null labels are one
label. An error or a sum of errors beyond a long is null, and null errors are left out of sums. An empty table gives an empty table. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicstream.llm.common import map_batches, mix64
from topicstream.session import shared_root, staged_table


@dataclass(frozen=True)
class Settings:
    parts: int = 4
    entries: int = 256
    rounds: int = 4
    scale: int = 1024
    members: int = 512  # parts an owner is meant to hold
    partition_bytes: int = 32_000_000


Books = list[np.ndarray]  # per part position (entries, length of a part)


def whole(vectors: list[list[float]], width: int, scale: int, kind) -> np.ndarray:
    """(rows, width) floors of the scaled components, filled up with zeros."""
    out = np.zeros((len(vectors), width), kind)
    for i, v in enumerate(vectors):
        x = np.asarray(v, np.float64)
        if kind is object:  # beyond 1e300 a double is a whole number
            out[i, : len(x)] = [math.floor(e * scale) if abs(e) < 1e300 else int(e) * scale for e in x.tolist()]
        else:
            out[i, : len(x)] = np.floor(x * scale)
    return out


def nearest(parts: np.ndarray, book: np.ndarray, block: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part, the lower one of equals, and the squared distances."""
    entry, error = np.empty(len(parts), np.int64), np.empty(len(parts), object if parts.dtype == object else np.int64)
    exact = parts.dtype == object
    b = book if exact else book.astype(np.float64)
    for lo in range(0, len(parts), 64 if exact else block):
        if exact:
            p = parts[lo : lo + 64]
            square = ((p[:, None] - b[None]) ** 2).sum(axis=2)
        else:
            p = parts[lo : lo + block].astype(np.float64)
            square = (p * p).sum(1)[:, None] - 2 * p @ b.T + (b * b).sum(1)[None]
        best = square.argmin(axis=1)
        entry[lo : lo + len(p)] = best
        error[lo : lo + len(p)] = square[np.arange(len(p)), best]
    return entry, error


def grouped(entry: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each entry with the places that hold it."""
    turn = np.argsort(entry, kind="stable")
    names, cuts = np.unique(entry[turn], return_index=True)
    ends = np.append(cuts[1:], len(turn))
    for name, lo, hi in zip(names.tolist(), cuts, ends[: len(names)], strict=True):
        yield name, turn[lo:hi]


def salted(place: tuple[int, int], ids: np.ndarray, parts: np.ndarray, salts: dict) -> Iterator[tuple]:
    """The members of an entry, dealt to its owners."""
    salt = (mix64(ids.view(np.uint64)) % np.uint64(salts.get(place, 1))).astype(np.int64)
    for name, rows in grouped(salt):
        yield (*place, name), (ids[rows], parts[rows])


def by_owner(records: Iterator[tuple]) -> Iterator[tuple[tuple, np.ndarray, np.ndarray]]:
    """The members of a partition, one block per owner."""
    held: dict = {}
    for owner, block in records:
        held.setdefault(owner, []).append(block)
    for owner in sorted(held):
        blocks = held.pop(owner)
        yield owner, np.concatenate([b[0] for b in blocks]), np.concatenate([b[1] for b in blocks])


def sums(resident: RDD, books: Books) -> Books:
    """New codebooks from the resident members: floors of the means; entries without members stay."""

    def add(records: Iterator[tuple]) -> Iterator[tuple]:
        held: dict = {}
        for (position, entry, _), (_, parts) in records:
            total = parts.sum(axis=0, dtype=object if parts.dtype == object else np.int64)
            n, old = held.get((position, entry), (0, 0))
            held[position, entry] = (n + len(parts), old + total)
        yield from held.items()

    out = [b.copy() for b in books]
    both = resident.mapPartitions(add).reduceByKey(lambda x, y: (x[0] + y[0], x[1] + y[1]))
    for (position, entry), (n, total) in both.collect():  # one row per entry at most
        out[position][entry] = total // n
    return out


def reassigned(resident: RDD, books: Books) -> RDD:
    """Members under new codebooks: (owner, members) for those that stay, ((position, entry), members) for those that go."""

    def assign(records: Iterator[tuple]) -> Iterator[tuple]:
        going: dict = {}
        for owner, ids, parts in by_owner(records):
            entry, _ = nearest(parts, books[owner[0]])
            stay = entry == owner[1]
            if stay.any():
                yield owner, (ids[stay], parts[stay])
            ids, parts = ids[~stay], parts[~stay]
            for name, rows in grouped(entry[~stay]):
                going.setdefault((owner[0], name), []).append((ids[rows], parts[rows]))
        for place, blocks in going.items():
            yield place, tuple(np.concatenate(x) for x in zip(*blocks, strict=True))

    return resident.mapPartitions(assign, preservesPartitioning=True)


def final_codes(resident: RDD, books: Books) -> RDD:
    """Blocks (position, row numbers, entries, squared distances) under the final codebooks."""

    def assign(records: Iterator[tuple]) -> Iterator[tuple]:
        for (position, _, _), ids, parts in by_owner(records):
            entry, error = nearest(parts, books[position])
            if error.dtype == object:
                error = np.array([e if e < 1 << 63 else -1 for e in error.tolist()], np.int64)
            yield position, ids.tobytes(), entry.astype(np.int32).tobytes(), error.tobytes()

    return resident.mapPartitions(assign)


def kept_on_disk(rdd: RDD) -> RDD:
    """A reliable checkpoint in the shared folder, computed once."""
    context = rdd.ctx
    if context._jsc.sc().getCheckpointDir().isEmpty():
        from pyspark.sql import SparkSession

        context.setCheckpointDir(shared_root(SparkSession.getActiveSession()))
    rdd.persist(StorageLevel.DISK_ONLY)
    rdd.checkpoint()
    rdd.count()
    rdd.unpersist()
    return rdd


def owner_partition(count: int):
    """Owners of an entry lie in successive partitions. One function object for all shuffles: equal partitionings are told by it."""

    def place(owner: tuple[int, int, int]) -> int:
        return (owner[0] * count + owner[1]) * 7919 + owner[2]

    return place


def owners_needed(sizes: dict, settings: Settings) -> dict:
    return {place: -(-n // settings.members) for place, n in sizes.items()}


def fit_codes(rows: DataFrame, settings: Settings) -> tuple[DataFrame, Books]:
    """``rows`` (row, vec_id, embedding), staged and usable, to (row, position, entry, error), and the final codebooks."""
    spark = rows.sparkSession
    largest = F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double"))))
    facts = rows.agg(F.max(F.size("embedding")).alias("width"), F.max(largest).alias("most"), F.count("*").alias("n")).head()
    length = max(1, -(-(facts["width"] or 0) // settings.parts))
    width = length * settings.parts
    top = (facts["most"] or 0.0) * settings.scale + 1
    kind = np.min_scalar_type(-int(top)).type if 4 * length * top * top < 2**53 else object
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(settings.entries).select("embedding").collect()
    start = whole([r[0] for r in first], width, settings.scale, kind)
    books = [b.astype(object if kind is object else np.int64) for b in np.split(start, settings.parts, axis=1)]
    opening = books

    def first_blocks(batch: pa.RecordBatch) -> dict:
        ids = batch.column("row").to_numpy()
        out: dict = {c: [] for c in ("position", "entry", "n", "ids", "parts")}
        x = whole(batch.column("embedding").to_pylist(), width, settings.scale, kind)
        for position, parts in enumerate(np.split(x, settings.parts, axis=1)):
            for entry, at in grouped(nearest(parts, opening[position])[0]):
                for name, value in zip(out, (position, entry, len(at), pickle.dumps(ids[at]), pickle.dumps(parts[at])), strict=True):
                    out[name].append(value)
        return out

    blocks = map_batches(rows.select("row", "embedding"), first_blocks, "position int, entry int, n long, ids binary, parts binary")
    blocks = staged_table(blocks, "lloyd-first")
    sizes = {(r["position"], r["entry"]): r["n"] for r in blocks.groupBy("position", "entry").agg(F.sum("n").alias("n")).collect()}
    salts = owners_needed(sizes, settings)
    bytes_all = facts["n"] * width * (np.dtype(kind).itemsize + 8)
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-bytes_all // settings.partition_bytes))
    place = owner_partition(settings.entries)

    def unpacked(row) -> list[tuple]:
        members = pickle.loads(row["ids"]), pickle.loads(row["parts"])
        return list(salted((row["position"], row["entry"]), *members, opened))

    opened = salts
    resident = blocks.rdd.flatMap(unpacked).partitionBy(partitions, place)
    for turn in range(settings.rounds):
        books = sums(resident, books)
        if turn + 1 == settings.rounds:
            break
        moved = kept_on_disk(reassigned(resident, books))
        counted = moved.map(lambda r: (r[0][:2], len(r[1][0]))).reduceByKey(lambda x, y: x + y)
        resident = settle(moved, owners_needed(dict(counted.collect()), settings), partitions, place)
    schema = "position int, ids binary, entries binary, errors binary"
    coded = spark.createDataFrame(final_codes(resident, books), schema)

    def spread(batch: pa.RecordBatch) -> dict:
        parts = {c: np.concatenate([np.frombuffer(b, t) for b in batch.column(c).to_pylist()]) for c, t in (("ids", np.int64), ("entries", np.int32), ("errors", np.int64))}
        lengths = [len(b) // 8 for b in batch.column("ids").to_pylist()]
        error = pa.array(parts["errors"], mask=parts["errors"] < 0)
        return {"row": parts["ids"], "position": np.repeat(batch.column("position").to_numpy(), lengths), "entry": parts["entries"], "error": error}

    return map_batches(coded, spread, "row long, position int, entry int, error long"), books


def settle(moved: RDD, salts: dict, partitions: int, place) -> RDD:
    """Members that stay, in place, with those that go, sent to an owner of their new entry; only the latter are shuffled."""
    stay = moved.filter(lambda r: len(r[0]) == 3)
    going = moved.filter(lambda r: len(r[0]) == 2)
    return stay.union(going.flatMap(lambda r: salted(r[0], *r[1], salts)).partitionBy(partitions, place))


def books_digest(books: Books) -> str:
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()


def compress(embeddings: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``embeddings`` (vec_id, embedding, label) to vec_id, code, error, label_error, codebooks_sha256, one row per usable vector."""
    finite = F.forall(F.col("embedding").cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = embeddings.select("vec_id", "label", "embedding").filter(F.coalesce(finite, F.lit(False)))
    rows = staged_table(usable.withColumn("row", F.monotonically_increasing_id()), "lloyd-rows")
    coded, books = fit_codes(rows, settings)
    digits = max(2, len(f"{settings.entries - 1:x}"))
    parts = F.array_sort(F.collect_list(F.struct("position", "entry")))
    code = F.array_join(F.transform(parts, lambda p: F.lpad(F.lower(F.hex(p["entry"])), digits, "0")), "")
    per_row = coded.groupBy("row").agg(code.alias("code"), F.try_sum("error").alias("error"), F.count("error").alias("n"))
    per_row = per_row.withColumn("error", F.when(F.col("n") == settings.parts, F.col("error"))).drop("n")
    out = staged_table(rows.select("row", "vec_id", "label").join(per_row, "row"), "lloyd-codes")
    of_label = out.groupBy(F.col("label").alias("of")).agg(F.try_sum("error").alias("label_error"))
    joined = out.join(of_label, out.label.eqNullSafe(of_label.of))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
