"""Quality classifier: random Fourier features, ridge regression from summed normal equations, isotonic calibration.

Every whole text becomes ``STATISTICS``, numbers about its characters, words and lines. Cosines of random projections of
the standardised numbers approximate a Gaussian kernel. Each partition adds up the normal equations of its labelled rows, one
system per fold; the sums are merged in tasks and the small systems solved on the driver. Out-of-fold scores
of all labelled rows, counted in fixed bins, give the isotonic calibration from raw score to probability.

Defined results: null text counts as empty and is scored like any other; a row without an id is never labelled; several labels of one
id count as their maximum; with no label at all every score is 0.5, with labels of one class only it is that class. Repeated rows are
scored one by one, extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicstream.llm.common import map_batches, text_bytes
from topicstream.session import staged_table

STATISTICS = (
    "log_bytes log_words word_length long_words distinct_words top_word lines line_words distinct_lines top_line "
    "upper digit space punctuation symbol pipe shout high entropy sentence symbol_words upper_words alpha_words"
).split()
WIDTH = len(STATISTICS)

_CODES = np.arange(256)
_UPPER = (_CODES >= 65) & (_CODES <= 90)
_LOWER = (_CODES >= 97) & (_CODES <= 122)
_DIGIT = (_CODES >= 48) & (_CODES <= 57)
_SPACE = np.isin(_CODES, list(b" \t\n\r\v\f"))
_PUNCTUATION = np.isin(_CODES, list(b".,;:?'\"()-"))
_PRINTABLE = (_CODES > 32) & (_CODES < 127)
_SYMBOL = _PRINTABLE & ~(_UPPER | _LOWER | _DIGIT | _PUNCTUATION)


@dataclass(frozen=True)
class Settings:
    features: int = 192
    folds: int = 4
    ridge: float = 1e-3  # times the number of labelled rows
    bins: int = 1000
    merge_width: int = 32  # partial sums one merging task reads
    seed: int = 5


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # (folds + 1, features + 1); the last one is fitted on all folds
    knots: np.ndarray  # raw scores and their calibrated values
    values: np.ndarray


def statistics(text: bytes) -> list[float]:
    """The numbers of one text, all of it."""
    if not text:
        return [0.0] * WIDTH
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n = len(text)
    words = text.split()
    m = max(1, len(words))
    lines = [x for x in text.split(b"\n") if x.strip()]
    k = max(1, len(lines))
    share = counts[counts > 0] / n
    tally: dict[bytes, int] = {}
    for w in words:
        tally[w] = tally.get(w, 0) + 1
    rows: dict[bytes, int] = {}
    for x in lines:
        rows[x] = rows.get(x, 0) + 1
    distinct = list(tally)
    symbols = sum(tally[w] for w in distinct if not w[-1:].isalnum() and w[-1] in b"!#$%&*|@^~<>=+_/\\")
    return [
        np.log1p(n),
        np.log1p(len(words)),
        sum(map(len, words)) / m,
        sum(c for w, c in tally.items() if len(w) > 20) / m,
        len(tally) / m,
        max(tally.values(), default=0) / m,
        np.log1p(len(lines)),
        np.log1p(len(words) / k),
        len(rows) / k,
        max(rows.values(), default=0) / k,
        counts[_UPPER].sum() / n,
        counts[_DIGIT].sum() / n,
        counts[_SPACE].sum() / n,
        counts[_PUNCTUATION].sum() / n,
        counts[_SYMBOL].sum() / n,
        counts[ord("|")] / m,
        counts[ord("!")] / m,
        counts[128:].sum() / n,
        float(-(share * np.log2(share)).sum()),
        (counts[ord(".")] + counts[ord("?")]) / m,
        symbols / m,
        sum(c for w, c in tally.items() if w.isupper()) / m,
        sum(c for w, c in tally.items() if w.isalpha()) / m,
    ]


def text_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns (none of this name) and ``stats``, an array of the numbers in ``STATISTICS``."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema) + ", stats array<double>"

    def transform(batch: pa.RecordBatch) -> dict:
        flat = np.array([statistics(t) for t in text_bytes(batch.column("text"))]).ravel()
        offsets = np.arange(0, len(flat) + 1, WIDTH, dtype=np.int32)
        stats = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
        return {name: batch.column(name) for name in keep} | {"stats": stats}

    return map_batches(docs.select(*dict.fromkeys([*keep, "text"])), transform, ddl)


def matrix(batch: pa.RecordBatch, column: str = "stats") -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def projection(settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Random frequencies of a Gaussian kernel whose width is the root of the number of statistics, and phases."""
    rng = np.random.default_rng(settings.seed)
    return rng.standard_normal((WIDTH, settings.features)) / np.sqrt(WIDTH), rng.uniform(0, 2 * np.pi, settings.features)


def fourier(x: np.ndarray, mean: np.ndarray, scale: np.ndarray, settings: Settings) -> np.ndarray:
    frequencies, phases = projection(settings)
    z = np.sqrt(2 / settings.features) * np.cos(np.clip((x - mean) / scale, -8, 8) @ frequencies + phases)
    return np.hstack([z, np.ones((len(x), 1))])


def summed(df: DataFrame, size: int, width: int) -> DataFrame:
    """Add up binary rows of ``size`` doubles: every task keeps one running sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for x in batch.column("part"):
                total += np.frombuffer(x.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    n = df.rdd.getNumPartitions()
    return df.repartition(max(1, -(-n // width))).mapInArrow(run, "part binary")


def normal_equations(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, settings: Settings) -> np.ndarray:
    """Per fold the summed outer products and products with the label, ``(folds, features + 1, features + 2)``.

    ``rows`` has stats, fold and label. Partitions add up first; partial sums are merged by tasks until few are left.
    """
    d, folds = settings.features + 1, settings.folds
    size = folds * d * (d + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((folds, d, d + 1))
        for batch in batches:
            z = fourier(matrix(batch), mean, scale, settings)
            y, fold = batch.column("label").to_numpy(), batch.column("fold").to_numpy()
            right = np.hstack([z, y[:, None]])
            for k in range(folds):
                total[k] += z[fold == k].T @ right[fold == k]
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    parts = staged_table(rows.select("stats", "fold", "label").mapInArrow(run, "part binary"), "quality-sums")
    while parts.rdd.getNumPartitions() > settings.merge_width:
        parts = staged_table(summed(parts, size, settings.merge_width), "quality-sums")
    return sum((np.frombuffer(r[0]) for r in parts.toLocalIterator()), np.zeros(size)).reshape(folds, d, d + 1)


def solve(sums: np.ndarray, ridge: float) -> np.ndarray:
    """Ridge weights without each fold in turn, then with all of them."""
    d = sums.shape[1]
    weights = []
    for left_out in [*range(len(sums)), None]:
        total = sums.sum(axis=0) - (0 if left_out is None else sums[left_out])
        rows = max(1.0, total[d - 1, d - 1])
        weights.append(np.linalg.solve(total[:, :d] + ridge * rows * np.eye(d), total[:, d]))
    return np.array(weights)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; returns the centre and the value of every pool."""
    pools: list[list[float]] = []
    for xi, yi, wi in zip(x, y, weight, strict=True):
        pools.append([xi * wi, yi * wi, wi])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    p = np.array(pools)
    return p[:, 0] / p[:, 2], p[:, 1] / p[:, 2]


def fit(stats: DataFrame, labels: DataFrame, trainable: Column, settings: Settings = Settings()) -> Model | None:
    """``stats``: doc_id, stats. ``labels``: doc_id, label (0/1). Only rows where ``trainable`` holds teach anything."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("label").cast("double").alias("label"))
    fold = F.pmod(F.xxhash64(F.lit(settings.seed), "doc_id"), F.lit(settings.folds)).cast("int")
    rows = stats.filter(trainable).join(known, "doc_id").select("stats", "label", fold.alias("fold"))
    rows = staged_table(rows, "quality-train")
    cells = [F.get("stats", F.lit(i)) for i in range(WIDTH)]
    moments = rows.agg(
        F.count("*").alias("n"), F.avg("label").alias("mean"), F.array(*map(F.avg, cells)), F.array(*map(F.stddev_pop, cells))
    ).head()
    if not moments["n"]:
        return None
    mean, scale = np.array(moments[2]), np.array(moments[3])
    scale[scale < 1e-9] = 1.0
    if moments["mean"] in (0.0, 1.0):
        empty = np.zeros((settings.folds + 1, settings.features + 1))
        return Model(mean, scale, empty, np.array([0.0]), np.array([moments["mean"]]))
    weights = solve(normal_equations(rows, mean, scale, settings), settings.ridge)

    def out_of_fold(batch: pa.RecordBatch) -> dict:
        z = fourier(matrix(batch), mean, scale, settings)
        raw = (z * weights[batch.column("fold").to_numpy()]).sum(axis=1)
        position = np.clip((raw + 0.5) / 2, 0, 1) * settings.bins
        return {"bin": position.astype(np.int32), "raw": raw, "label": batch.column("label")}

    scored = map_batches(rows, out_of_fold, "bin int, raw double, label double").groupBy("bin")
    bins = scored.agg(F.avg("raw").alias("raw"), F.avg("label").alias("label"), F.count("*").alias("n")).orderBy("bin")
    table = np.array([(r["raw"], r["label"], r["n"]) for r in bins.collect()])
    return Model(mean, scale, weights, *isotonic(*table.T))


def predict(stats: DataFrame, model: Model | None, settings: Settings = Settings()) -> DataFrame:
    """Adds score (0 to 1) and predicted (0 or 1) to rows with ``stats``, which is dropped."""
    kept = [f for f in stats.schema if f.name != "stats"]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", score double, predicted int"

    def transform(batch: pa.RecordBatch) -> dict:
        if model is None:
            score = np.full(batch.num_rows, 0.5)
        else:
            raw = fourier(matrix(batch), model.mean, model.scale, settings) @ model.weights[-1]
            score = np.clip(np.interp(raw, model.knots, model.values), 0, 1)
        columns = {f.name: batch.column(f.name) for f in kept}
        return columns | {"score": score, "predicted": (score >= 0.5).astype(np.int32)}

    return map_batches(stats, transform, ddl)
