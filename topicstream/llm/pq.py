"""Near-duplicate embeddings by product quantisation.

Vectors are scaled to length one, so a cosine of at least t is a distance of at most r = sqrt(2 - 2t). Coarse centres, fitted
on a bounded sample, cut each label's vectors into inverted lists. In a list a vector is kept as codes: its residual from the centre,
cut into subspaces, each replaced by one of 256 codewords, and the length e of what the codes miss.

Equal vectors are one row with a count. Every vector probes its own list and every other list whose cell it comes within r of:
a neighbour's centre is nearer to it than to any other, so a vector farther than r from the bisecting plane has no
neighbour there. In a probed list, table look-ups give the distance to each coded vector, which is off by at most e; vectors farther than r + e are
passed over, all others are compared by the exact cosine in double precision. So probes and codes lose no link, whatever the sample was.

Long lists are cut into blocks and a pair of blocks is one group; a group gives per vector its number of links and a spanning forest of
its links, never all pairs. Components come from the forests.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components, and rows without a label, link with nothing. Vectors
of different lengths never link. Rows that repeat a vec_id are vectors of their own and share the component if they link.
A null id takes no part in the smallest id. Extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicstream.llm.components import connected_components
from topicstream.session import staged_table

SLACK = 1e-6  # for rounding, on every bound


@dataclass(frozen=True)
class Settings:
    cosine: float = 0.98
    centres: int = 64
    subspaces: int = 8
    codewords: int = 256
    sample: int = 20_000  # bound of the rows the centres and codewords are fitted on
    iterations: int = 8
    block: int = 1024  # vectors of a list in one group
    seed: int = 3

    @property
    def radius(self) -> float:
        return float(np.sqrt(2 - 2 * self.cosine))


@dataclass
class Codebook:
    centres: np.ndarray  # (lists, d)
    words: list[np.ndarray]  # per subspace (codewords, part of d)

    def cut(self, x: np.ndarray) -> list[np.ndarray]:
        return np.array_split(x, len(self.words), axis=1)

    def encode(self, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and the lengths of what they miss."""
        codes = np.stack([distances(part, w).argmin(axis=1) for part, w in zip(self.cut(residual), self.words, strict=True)], axis=1)
        told = np.hstack([w[codes[:, i]] for i, w in enumerate(self.words)])
        return codes.astype(np.uint8), np.linalg.norm(residual - told, axis=1)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ y.T + (y * y).sum(1)[None], 0)


def k_means(x: np.ndarray, k: int, rng: np.random.Generator, iterations: int) -> np.ndarray:
    """At most k centres of a bounded sample."""
    centres = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(iterations):
        own = distances(x, centres).argmin(axis=1)
        for c in np.unique(own):
            centres[c] = x[own == c].mean(axis=0)
    return centres


def fit(units: np.ndarray, settings: Settings) -> Codebook:
    """Centres and the codewords of residuals, from a sample of unit vectors."""
    rng = np.random.default_rng(settings.seed)
    centres = k_means(units, settings.centres, rng, settings.iterations)
    residual = units - centres[distances(units, centres).argmin(axis=1)]
    parts = np.array_split(residual, min(settings.subspaces, units.shape[1]), axis=1)
    return Codebook(centres, [k_means(p, settings.codewords, rng, settings.iterations) for p in parts])


def probes(x: np.ndarray, centres: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """The list of every unit vector, and a mask of all lists that may hold a vector within ``radius``."""
    to = distances(x, centres)
    own = to.argmin(axis=1)
    between = np.sqrt(distances(centres, centres))[own]
    beyond = (to - to[np.arange(len(x)), own][:, None]) / np.maximum(2 * between, 1e-12)
    return own, (beyond <= radius + SLACK) | (between <= 1e-12)


def linked_block(queries: dict, stored: dict, book: Codebook, settings: Settings) -> tuple[np.ndarray, np.ndarray, list[tuple]]:
    """Links between the query vectors and the coded vectors of one block of one list.

    Returns the positions of queries with links, the number of vectors they link to, and a forest of (query id, stored id).
    """
    residual = queries["unit"] - book.centres[stored["list"]]
    tables = [distances(part, w) for part, w in zip(book.cut(residual), book.words, strict=True)]
    told = sum(t[:, stored["codes"][:, i]] for i, t in enumerate(tables))
    near = np.sqrt(told) <= settings.radius + stored["missed"][None] + SLACK
    count = np.zeros(len(residual), np.int64)
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    forest = []
    for q in np.flatnonzero(near.any(axis=1)):
        at = np.flatnonzero(near[q])
        a, b = queries["vector"][q], stored["vector"][at]
        cosine = (b @ a) / (np.sqrt((b * b).sum(1)) * np.sqrt(a @ a))
        at = at[(cosine >= settings.cosine) & (stored["key"][at] != queries["key"][q])]
        count[q] = stored["copies"][at].sum()
        for other in stored["key"][at]:
            x, y = root(queries["key"][q]), root(other)
            if x != y:
                parent[x] = y
                forest.append((queries["key"][q], other))
    found = np.flatnonzero(count)
    return found, count[found], forest


def matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


def tame(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two, which changes no cosine, so that squares neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = tame(x)
    return x / np.sqrt((x * x).sum(1))[:, None]


def coded(vectors: DataFrame, books: dict[int, Codebook], settings: Settings) -> DataFrame:
    """Vectors (key, label, vector, copies) with their list, codes, missed length and the lists they probe."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column("width").to_numpy()
            for width in np.unique(widths):
                rows = batch.filter(pa.array(widths == width))
                book, unit = books[int(width)], unit_rows(matrix(rows.column("vector"), rows.num_rows))
                own, mask = probes(unit, book.centres, settings.radius)
                codes, missed = book.encode(unit - book.centres[own])
                lists = [np.flatnonzero(m).astype(np.int32) for m in mask]
                columns = [rows.column(c) for c in ("key", "label", "width", "vector", "copies")]
                columns += [pa.array(own, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(missed)]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(lists, pa.list_(pa.int32()))], names)

    names = ["key", "label", "width", "vector", "copies", "list", "codes", "missed", "probes"]
    kind = vectors.schema["label"].dataType.simpleString()
    ddl = f"key string, label {kind}, width int, vector array<double>, copies long, list int, codes binary, missed double, probes array<int>"
    return vectors.select("key", "label", "width", "vector", "copies").mapInArrow(run, ddl)


def near_duplicates(embeddings: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``embeddings`` (vec_id, embedding, label) to vec_id, n_links, component_id, kept, one row per vector."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("vector").isNotNull() & F.col("label").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    rows = embeddings.select("vec_id", "label", vector.alias("vector")).withColumn("usable", F.coalesce(usable, F.lit(False)))
    plain = F.transform("vector", lambda x: x + F.lit(0.0))  # one zero
    key = F.sha2(F.to_json(F.struct(F.col("label").cast("string").alias("l"), plain.alias("v"))), 256)
    rows = staged_table(rows.select("vec_id", "label", "vector", F.when(F.col("usable"), key).alias("key")), "pq-rows")
    sets = rows.filter("key is not null").groupBy("key").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"), F.count("*").alias("copies"), F.min("vec_id").alias("first_id")
    )
    sets = staged_table(sets.withColumn("width", F.size("vector")), "pq-vectors")
    books, sample = {}, {}
    total = max(1, sets.count())
    share = min(1.0, settings.sample / total)
    drawn = sets.filter(F.pmod(F.xxhash64(F.lit(settings.seed), "key"), F.lit(1_000_000)) < share * 1e6).orderBy("key").limit(settings.sample)
    for row in drawn.select("vector").collect():
        sample.setdefault(len(row["vector"]), []).append(row["vector"])
    for width in [r["width"] for r in sets.select("width").distinct().collect()]:  # one per length of vectors
        x = np.array(sample.get(width) or np.eye(1, width))
        books[width] = fit(unit_rows(x), settings)
    marked = staged_table(coded(sets, books, settings), "pq-coded")

    spot = ["label", "width", "list"]
    blocks = marked.groupBy(*spot).agg(F.ceil(F.count("*") / settings.block).cast("int").alias("blocks"))
    stored = marked.join(blocks, spot)
    stored = stored.withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    stored = stored.select(*spot, "block", "key", "vector", "copies", "codes", "missed")
    # queries of a list are cut into as many pieces as it has blocks; every block meets every piece
    numbers = F.sequence(F.lit(0), F.col("blocks") - 1)
    stored = stored.join(blocks, spot).withColumn("piece", F.explode(numbers)).drop("blocks")
    asked = marked.select("label", "width", F.explode("probes").alias("list"), "key", "vector").join(blocks, spot)
    piece = F.pmod(F.xxhash64("key", F.lit(1)), F.col("blocks")).cast("int").alias("piece")
    asked = asked.select(*spot, F.explode(numbers).alias("block"), piece, "key", "vector")
    asked = asked.toDF(*[f"q_{c}" for c in asked.columns])
    group = [*spot, "block", "piece"]

    def compare(name: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table([[], [], [], []], schema=result)
        width, number = name[1].as_py(), name[2].as_py()
        here = {
            "list": number,
            "key": np.array(right.column("key").to_pylist(), object),
            "vector": tame(matrix(right.column("vector").combine_chunks(), right.num_rows)),
            "copies": right.column("copies").to_numpy(),
            "codes": np.frombuffer(b"".join(right.column("codes").to_pylist()), np.uint8).reshape(right.num_rows, -1),
            "missed": right.column("missed").to_numpy(),
        }
        keys = np.array(left.column("q_key").to_pylist(), object)
        vectors = tame(matrix(left.column("q_vector").combine_chunks(), left.num_rows))
        units, out = unit_rows(vectors), []
        for at in range(0, len(keys), 512):
            part = slice(at, at + 512)
            ask = {"key": keys[part], "vector": vectors[part], "unit": units[part]}
            found, count, forest = linked_block(ask, here, books[width], settings)
            out += [(keys[at + i], int(n), None, None) for i, n in zip(found, count, strict=True)]
            out += [(None, None, a, b) for a, b in forest]
        return pa.table([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), result, strict=True)] if out else [[], [], [], []], schema=result)

    result = pa.schema([("key", pa.string()), ("n", pa.int64()), ("a", pa.string()), ("b", pa.string())])
    found = asked.groupBy(*[f"q_{c}" for c in group]).cogroup(stored.groupBy(*group)).applyInArrow(compare, "key string, n long, a string, b string")
    found = staged_table(found, "pq-links")
    counts = found.filter("key is not null").groupBy("key").agg(F.sum("n").alias("n"))
    component = connected_components(found.filter("a is not null").select("a", "b"))
    node = sets.select("key", "copies", "first_id").join(component, sets.key == component.node, "left").join(counts, "key", "left")
    node = node.select("key", "copies", "first_id", F.coalesce("component", "key").alias("component"), F.coalesce("n", F.lit(0)).alias("n"))
    least = node.groupBy("component").agg(F.min("first_id").alias("component_id"))
    node = node.join(least, "component").select("key", (F.col("n") + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.select("vec_id", "key").join(node, "key", "left")
    component_id = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component_id.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
