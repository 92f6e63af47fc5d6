"""Helpers the training-data operators share."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicstream.session import PLANNER_SETTINGS, ship_package

# Texts are long and a Python worker holds one Arrow batch at a time.
SETTINGS = {**PLANNER_SETTINGS, "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


def prepare(spark: SparkSession) -> None:
    """Planner settings and the package on the workers; safe to call again."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file, the same on all machines."""
    import public_tokenizers

    return public_tokenizers.path(name)


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % modulus, F.lit(-1))


def text_bytes(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def map_batches(df: DataFrame, transform: Callable[[pa.RecordBatch], dict | None], schema: str) -> DataFrame:
    """``mapInArrow`` for a function from one batch to the columns of one batch (None: no rows)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = transform(batch) if batch.num_rows else None
            if columns is not None:
                yield to_batch(columns, target)

    return df.mapInArrow(run, schema)


def to_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    arrays = [
        columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type) for f in schema
    ]
    return pa.RecordBatch.from_arrays([a if a.type == f.type else a.cast(f.type) for a, f in zip(arrays, schema, strict=True)], schema=schema)


# What stands between words of digits, lower-case letters and characters beyond ASCII: 00-2F, 3A-60 and 7B-7F.
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
TO_SPACE = bytes.maketrans(SEPARATORS, b" " * len(SEPARATORS))
SEPARATOR = re.compile(b"[%s]" % re.escape(SEPARATORS))


def lowered_pieces(text: bytes, size: int) -> Iterator[bytes]:
    """The whole text with A-Z lower-cased, in pieces of about ``size`` bytes that end behind a separator, so no word is cut."""
    text, at = text.lower(), 0
    while len(text) - at > size:
        found = SEPARATOR.search(text, at + size)
        if found is None:
            break
        yield text[at : found.end()]
        at = found.end()
    yield text[at:]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words: two xor-shift-multiply rounds."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def bitmap_size(count: int, bits_each: int, most_bits: int) -> int:
    """A power of two of bits, ``bits_each`` for each of ``count`` hashes or more, within its bounds."""
    return min(most_bits, max(1 << 15, 1 << math.ceil(math.log2(max(1, count) * bits_each))))


def bitmap(hashes: DataFrame, column: str, bits: int) -> np.ndarray:
    """The bitmap of the highest bits of a column's 64-bit hashes; ``bits`` is a power of two, so it is ``bits / 8`` bytes whatever the rows."""
    place = F.shiftrightunsigned(column, 64 - bits.bit_length() + 1) + 1  # Spark's bitmaps count from 1
    parts = hashes.select(place.alias("place")).groupBy(F.expr("bitmap_bucket_number(place)").alias("part"))
    out = np.zeros(bits // 8, np.uint8)
    for row in parts.agg(F.expr("bitmap_construct_agg(bitmap_bit_position(place))").alias("bits")).collect():
        at = (row["part"] - 1) * 4096
        out[at : at + 4096] = np.frombuffer(row["bits"], np.uint8)[: len(out) - at]
    return out


def in_bitmap(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which 64-bit hashes the bitmap may hold; those it was made of are always among them."""
    place = values >> np.uint64(64 - (len(bitmap) * 8).bit_length() + 1)
    return (bitmap[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def text_volume(df: DataFrame, column: str) -> int:
    """UTF-8 bytes in ``column``; a narrow scan and one sum."""
    return df.agg(F.sum(F.octet_length(column))).head()[0] or 0


def boxed(docs: DataFrame, needed: tuple[str, ...]) -> tuple[DataFrame, list[Column]]:
    """``docs`` with all columns but the ``needed`` ones renamed, so that none clashes, and the columns to restore."""
    names = {c: c if c in needed else f"_column_{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    return renamed, [F.col(n).alias(c) for c, n in names.items()]
