"""Distances between rows and cluster centers.

Centers are shipped to the tasks in blocks of bounded size and compared with whole Arrow batches by
one matrix product; only the vector column passes through Python. A model that fits one block costs
a single narrow pass. A larger one is handled block by block, each pass keeping the best hit so far,
so the size of the model is never limited by what one process can hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicstream.session import cut_lineage

BLOCK_BYTES = 128 * 1024 * 1024
HIT = "struct<cluster_id:long,dist:double>"


# --- helpers that run inside tasks ------------------------------------------------------------


def to_matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    """List column to a (rows, dims) float64 matrix."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, dtype=np.float64).reshape(len(vectors), dims)


def row_chunks(rows: int, width: int, cells: int = 1_000_000) -> Iterator[slice]:
    """Slices of rows so that a (rows, width) matrix stays small."""
    step = max(1, cells // max(1, width))
    for start in range(0, rows, step):
        yield slice(start, min(rows, start + step))


def rough_sqdist(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All squared distances by one matrix product, and a bound of their rounding error per row."""
    xn = np.einsum("ij,ij->i", x, x)
    cn = np.einsum("ij,ij->i", centers, centers)
    d = x @ centers.T  # the only matrix of this size; the rest happens in place
    d *= -2.0
    d += xn[:, None]
    d += cn[None, :]
    return d, 1e-12 * (xn + (cn.max() if len(cn) else 0.0) + 1.0)


def closer_than(x: np.ndarray, centers: np.ndarray, limit: float | np.ndarray) -> np.ndarray:
    """(rows, centers) matrix: squared distance below ``limit``, which may differ from row to row.

    Distances too close to the limit for the matrix product are taken from the differences.
    """
    rough, slack = rough_sqdist(x, centers)
    limits = np.broadcast_to(np.asarray(limit, dtype=np.float64), len(x))
    near = rough < (limits - slack)[:, None]
    r, c = np.nonzero(np.abs(rough - limits[:, None]) <= slack[:, None])
    near[r, c] = ((x[r] - centers[c]) ** 2).sum(axis=1) < limits[r]
    return near


def nearest_rows(
    x: np.ndarray, centers: np.ndarray, skip_equal: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the nearest center; -1 where there is none.

    The matrix product only selects the centers that can be nearest. Their distances are then
    computed from the differences, and the lowest index wins a tie.
    """
    best = np.full(len(x), -1, dtype=np.int64)
    dist = np.full(len(x), np.inf)
    if not len(centers):
        return best, dist
    for part in row_chunks(len(x), len(centers)):
        xs = x[part]
        rough, slack = rough_sqdist(xs, centers)
        if skip_equal:
            r, c = np.nonzero(rough <= slack[:, None])
            same = (xs[r] == centers[c]).all(axis=1)
            rough[r[same], c[same]] = np.inf
        low = rough.min(axis=1)
        r, c = np.nonzero((rough <= (low + 2 * slack)[:, None]) & np.isfinite(rough))
        d = ((xs[r] - centers[c]) ** 2).sum(axis=1)
        order = np.lexsort((c, d, r))
        r, c, d = r[order], c[order], d[order]
        first = np.ones(len(r), dtype=bool)
        first[1:] = r[1:] != r[:-1]
        best[part.start + r[first]] = c[first]
        dist[part.start + r[first]] = d[first]
    return best, dist


# --- model blocks -----------------------------------------------------------------------------


def center_blocks(
    model: DataFrame, block_bytes: int = BLOCK_BYTES
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, centers, weights) in id order; each block holds at most ``block_bytes`` of centers."""
    table = model.select("cluster_id", "center", "weight")
    last, first_rows = None, 1024
    while True:
        rest = table if last is None else table.filter(F.col("cluster_id") > last)
        # the first look is small: it tells the vector length, and is all there is for most models
        block = rest.orderBy("cluster_id").limit(first_rows).toArrow()
        if not block.num_rows:
            return
        dims = len(block.column("center")[0])
        rows = max(1, block_bytes // (8 * dims))
        complete = block.num_rows < first_rows
        if rows > block.num_rows and not complete:
            more = rest.filter(F.col("cluster_id") > block.column("cluster_id")[-1].as_py())
            more = more.orderBy("cluster_id").limit(rows - block.num_rows).toArrow()
            complete = more.num_rows < rows - block.num_rows
            block = pa.concat_tables([block, more])
        if rows < block.num_rows:
            block, complete = block.slice(0, rows), False
        ids = block.column("cluster_id").to_numpy()
        yield ids, to_matrix(block.column("center"), dims), block.column("weight").to_numpy()
        if complete:
            return
        last = int(ids[-1])


def small_model(model: DataFrame) -> list | None:
    """All blocks of a model that fits one block, to be read once for several passes; else None."""
    blocks = list(islice(center_blocks(model), 2))
    return blocks if len(blocks) == 1 else None


def nearest_column(df: DataFrame, vector: str, ids, centers, skip_equal: bool, seen: Column) -> Column:
    """Best hit among one block and the hit ``seen`` in earlier blocks (which hold lower ids)."""
    shared = df.sparkSession.sparkContext.broadcast((ids, centers))

    @F.arrow_udf(HIT)
    def nearest(vectors: pa.Array, seen_id: pa.Array, seen_dist: pa.Array) -> pa.Array:
        block_ids, block = shared.value
        pos, dist = nearest_rows(to_matrix(vectors, block.shape[1]), block, skip_equal)
        before = seen_dist.fill_null(np.inf).to_numpy(zero_copy_only=False)
        better = dist < before
        old = seen_id.fill_null(-1).to_numpy(zero_copy_only=False)
        hit = np.where(better, block_ids[pos], old)
        dist = np.where(better, dist, before)
        none = ~np.isfinite(dist)
        return pa.StructArray.from_arrays(
            [pa.array(hit, pa.int64(), mask=none), pa.array(dist, pa.float64(), mask=none)],
            names=["cluster_id", "dist"],
        )

    return nearest(vector, seen["cluster_id"], seen["dist"])


def predict(
    features: DataFrame,
    model: DataFrame,
    vector: str = "tfidf",
    skip_equal: bool = False,
    block_bytes: int = BLOCK_BYTES,
    blocks: list | None = None,
) -> DataFrame:
    """Adds ``cluster_id`` and ``sq_dist`` of the nearest center (null for an empty model).

    ``blocks`` passes on the centers of ``model`` when the caller has read them already.
    """
    hit = F.lit(None).cast(HIT)
    out = features.withColumn("_hit", hit)
    for n, (ids, centers, _) in enumerate(blocks or center_blocks(model, block_bytes)):
        if n:
            out = cut_lineage(out)
        hit = nearest_column(out, vector, ids, centers, skip_equal, F.col("_hit"))
        out = out.withColumn("_hit", hit)
    return out.select(
        *features.columns,
        F.col("_hit.cluster_id").alias("cluster_id"),
        F.col("_hit.dist").alias("sq_dist"),
    )


def nearest_neighbor_center(
    model: DataFrame,
    used: DataFrame | None = None,
    block_bytes: int = BLOCK_BYTES,
    blocks: list | None = None,
) -> DataFrame:
    """(cluster_id, neighbor_id, neighbor_dist): the nearest center with other values.

    A center without such a neighbor is its own neighbor.
    """
    centers = model.select(F.col("cluster_id").alias("of"), "center")
    if used is not None:
        centers = centers.join(used.select(F.col("cluster_id").alias("of")), "of", "left_semi")
    hits = predict(centers, model, "center", True, block_bytes, blocks)
    return hits.select(
        F.col("of").alias("cluster_id"),
        F.coalesce("cluster_id", "of").alias("neighbor_id"),
        F.coalesce("sq_dist", F.lit(0.0)).alias("neighbor_dist"),
    )


PAIR_BYTES = 4 * 1024 * 1024


def norm_bands(model: DataFrame, reach: float, block_bytes: int = PAIR_BYTES) -> DataFrame:
    """(a, b, later, cluster_id, center): every center once per pair of norm bands that may hold a pair within ``reach``.

    Two centers are at least as far apart as their norms. The norms are cut into bands of about ``block_bytes`` of centers; a band meets itself and
    the following ones up to ``reach``. The driver knows the limits of the bands, one number each, and no center.
    """
    norm = F.sqrt(F.aggregate("center", F.lit(0.0), lambda s, x: s + x * x))
    rows = model.select("cluster_id", "center", norm.alias("norm"))
    facts = rows.agg(F.count("*").alias("k"), F.max(F.size("center")).alias("dims")).head()
    bands = min(10_000, -(-facts["k"] * 8 * (facts["dims"] or 1) // block_bytes))
    limits = []
    if bands > 1:
        steps = [n / bands for n in range(1, bands)]
        limits = sorted(set(rows.agg(F.percentile_approx("norm", steps, 10 * bands)).head()[0]))
    low, high = [float("-inf"), *limits], [*limits, float("inf")]
    # the slack is above the rounding of the norms
    last = [max(b for b in range(a, len(low)) if b == a or low[b] - high[a] < reach + 1e-9 * (1 + abs(high[a]))) for a in range(len(low))]
    first = [min(a for a in range(b + 1) if last[a] >= b) for b in range(len(low))]
    band = F.size(F.filter(F.array(*[F.lit(x) for x in limits]), lambda x: x < F.col("norm"))) if limits else F.lit(0)
    placed = rows.withColumn("band", band.cast("int"))
    at = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("band") + 1)
    as_first = F.transform(F.sequence(F.col("band"), at(last)), lambda b: F.struct(F.col("band").alias("a"), b.alias("b"), F.lit(False).alias("later")))
    as_later = F.transform(F.sequence(at(first), F.col("band")), lambda a: F.struct(a.alias("a"), F.col("band").alias("b"), F.lit(True).alias("later")))
    return placed.select(F.explode(F.concat(as_first, as_later)).alias("met"), "cluster_id", "center").select("met.*", "cluster_id", "center")


def center_pairs(model: DataFrame, threshold: float = 25.0, block_bytes: int = PAIR_BYTES) -> DataFrame:
    """(id_i, id_j, dist) for centers i < j closer than ``threshold``: a band join on the norms; only hits leave the tasks."""

    def close(table: pa.Table) -> pa.Table:
        later = table.column("later").to_numpy()
        first, second = table.filter(pa.array(~later)), table.filter(pa.array(later))
        found = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        if first.num_rows and second.num_rows:
            dims, same = len(first.column("center")[0]), table.column("a")[0] == table.column("b")[0]
            x, y = to_matrix(first.column("center"), dims), to_matrix(second.column("center"), dims)
            own, other = first.column("cluster_id").to_numpy(), second.column("cluster_id").to_numpy()
            parts = []
            for part in row_chunks(len(x), len(y)):
                near = closer_than(x[part], y, threshold)
                r, c = np.nonzero(near & (own[part][:, None] < other[None, :]) if same else near)
                d = ((x[part][r] - y[c]) ** 2).sum(axis=1)
                i, j = own[part][r], other[c]
                parts.append((np.minimum(i, j), np.maximum(i, j), d))
            found = [np.concatenate(p) for p in zip(*parts)]
        return pa.table(dict(zip(("id_i", "id_j", "dist"), found)))

    met = norm_bands(model, float(np.sqrt(threshold)) if threshold > 0 else 0.0, block_bytes)
    return met.groupBy("a", "b").applyInArrow(close, "id_i long, id_j long, dist double")
