"""Language identification with a byte convolutional network.

The network reads fixed-length windows of UTF-8 bytes: an embedding per byte, filters of several widths over consecutive
bytes, ReLU, the maximum over the window, and a softmax over the languages. It is trained in numpy on the driver from a bounded
sample of labelled windows (``windows_per_language``), and applied to every window of every text; a text's log
probabilities are the means over its windows, weighted by the bytes in them.

Texts of any length are cut into windows whole. Of equal probabilities the first language in alphabetical order wins.

Defined results: null text or a text without a letter (Unicode category L) is ``und`` with score 0; with no labelled text at all everything is ``und``. Repeated
rows are scored one by one. Any other column is ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicstream.llm.common import map_batches

UNDETERMINED = "und"
LETTER = regex.compile(r"\p{L}")  # numerals such as those for fractions or in circles are none


@dataclass(frozen=True)
class Settings:
    window: int = 128
    embedding: int = 8
    filters: tuple[tuple[int, int], ...] = ((2, 8), (3, 16), (4, 16))  # (width, number)
    windows_per_language: int = 2000  # bound of the training sample
    most_windows: int = 400_000  # bound over all languages, which share it
    epochs: int = 12
    batch: int = 64
    rate: float = 0.01
    seed: int = 11


@dataclass
class Network:
    """Weights; ``kernel`` holds the filters of all widths, shorter ones padded with zeros."""

    languages: list[str]
    embedding: np.ndarray
    kernel: np.ndarray
    kernel_bias: np.ndarray
    head: np.ndarray
    head_bias: np.ndarray


def kernel_mask(settings: Settings) -> np.ndarray:
    widest = max(w for w, _ in settings.filters)
    columns = [np.repeat(np.arange(widest) < w, settings.embedding) for w, n in settings.filters for _ in range(n)]
    return np.array(columns, dtype=np.float32).T


def cut_windows(text: bytes, size: int) -> np.ndarray:
    """All windows of a text, the last one padded with blanks; text of ASCII letters in lower case."""
    data = text.lower()
    data += b" " * (-len(data) % size if data else size)
    return np.frombuffer(data, np.uint8).reshape(-1, size)


def activations(net: Network, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stacked inputs of the filters, the maximum of each filter per window, and where it is."""
    n, size = windows.shape
    depth = net.embedding.shape[1]
    widest = net.kernel.shape[0] // depth
    embedded = net.embedding[windows].reshape(n, size * depth)
    places = size - widest + 1
    stacked = np.lib.stride_tricks.sliding_window_view(embedded, widest * depth, axis=1)[:, ::depth]
    stacked = np.ascontiguousarray(stacked)
    response = (stacked.reshape(n * places, -1) @ net.kernel).reshape(n, places, -1)
    return stacked, response.max(axis=1), response


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def window_scores(net: Network, windows: np.ndarray, block: int = 256) -> np.ndarray:
    """Log probabilities per window, computed block by block in bounded memory."""
    parts = []
    for start in range(0, len(windows), block):
        _, top, _ = activations(net, windows[start : start + block])
        parts.append(log_softmax(np.maximum(top + net.kernel_bias, 0) @ net.head + net.head_bias))
    return np.concatenate(parts)


def train(windows: np.ndarray, labels: list[str], settings: Settings) -> Network:
    """Cross-entropy by Adam; classes are weighted so that a frequent language does not win by number."""
    rng = np.random.default_rng(settings.seed)
    languages = sorted(set(labels))
    y = np.searchsorted(languages, labels)
    weight = (len(y) / (len(languages) * np.bincount(y)))[y].astype(np.float32)
    mask = kernel_mask(settings)
    normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    params = {
        "embedding": normal(256, settings.embedding, scale=0.5),
        "kernel": normal(*mask.shape, scale=0.2) * mask,
        "kernel_bias": np.zeros(mask.shape[1], np.float32),
        "head": normal(mask.shape[1], len(languages), scale=0.2),
        "head_bias": np.zeros(len(languages), np.float32),
    }
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items()}
    net, step = Network(languages, **params), 0
    for epoch in range(settings.epochs):
        order = rng.permutation(len(y))
        for start in range(0, len(y), settings.batch):
            rows = order[start : start + settings.batch]
            gradients = backward(net, windows[rows], y[rows], weight[rows])
            gradients["kernel"] *= mask
            step += 1
            rate = settings.rate * (1 - epoch / settings.epochs)
            for name, g in gradients.items():
                m, v = moments[name]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                params[name] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def backward(net: Network, windows: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    n, depth = len(y), net.embedding.shape[1]
    stacked, top, response = activations(net, windows)
    at = response.argmax(axis=1)  # (n, filters)
    hidden = np.maximum(top + net.kernel_bias, 0)
    out = np.exp(log_softmax(hidden @ net.head + net.head_bias))
    out[np.arange(n), y] -= 1
    out *= (weight / n)[:, None]
    back = (out @ net.head.T) * (hidden > 0)
    picked = stacked[np.arange(n)[:, None], at]  # (n, filters, width * depth)
    widest = net.kernel.shape[0] // depth
    spread = back[:, :, None] * net.kernel.T[None]  # gradient of the picked inputs
    embedding = np.zeros_like(net.embedding)
    places = at[:, :, None] + np.arange(widest)[None, None]
    bytes_at = windows[np.arange(n)[:, None, None], places]
    np.add.at(embedding, bytes_at.ravel(), spread.reshape(-1, depth))
    return {
        "embedding": embedding,
        "kernel": np.einsum("nf,nfk->kf", back, picked),
        "kernel_bias": back.sum(axis=0),
        "head": hidden.T @ out,
        "head_bias": out.sum(axis=0),
    }


def fit(docs: DataFrame, trainable: Column, settings: Settings = Settings()) -> Network | None:
    """Train on rows of ``docs`` (doc_id, text, lang) where ``trainable`` holds and ``lang`` is not null.

    Per language at most about ``windows_per_language`` rows are drawn by a hash of id, text and row number, so rows without an id and rows that
    repeat one are drawn like all others; one window is taken at a hashed place of each.
    """
    row = F.xxhash64(F.lit(settings.seed), "doc_id", "text", F.monotonically_increasing_id())
    rows = docs.withColumn("_row", row).filter(trainable & F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.trim("text") != ""))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    each = min(settings.windows_per_language, max(1, settings.most_windows // len(counts)))
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, each / n))])
    draw = F.pmod("_row", F.lit(1_000_000)) / 1e6
    place = F.pmod(F.xxhash64(F.lit(settings.seed + 1), "_row"), F.greatest(F.length("text") - settings.window, F.lit(1)))
    sample = rows.filter(draw < share[F.col("lang")]).select(
        "lang", "doc_id", F.substring(F.col("text"), (place + 1).cast("int"), F.lit(settings.window)).alias("part")
    )
    found = sorted((r["lang"], r["doc_id"] or 0, r["part"]) for r in sample.collect())
    found = [x for x in found if x[2]]
    if not found:
        return None
    windows = np.stack([cut_windows(part.encode(), settings.window)[0] for _, _, part in found])
    return train(windows, [lang for lang, _, _ in found], settings)


def predict(docs: DataFrame, net: Network | None, keep: list[str], settings: Settings = Settings()) -> DataFrame:
    """``keep`` columns (none of them of these names) plus lang_pred and score for the whole text of each row."""
    size = settings.window
    schema = docs.select(*keep).schema
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ", lang_pred string, score double"

    def transform(batch: pa.RecordBatch) -> dict:
        texts = ["" if x is None else x for x in batch.column("text").to_pylist()]
        lettered = np.array([bool(LETTER.search(x)) for x in texts]) & (net is not None)
        label, score = np.full(len(texts), UNDETERMINED, object), np.zeros(len(texts))
        rows, windows, sizes, held = [], [], [], 0

        def settle() -> None:
            lengths = np.array([len(w) for w in windows])
            ends = np.cumsum(lengths)
            weight = np.full(ends[-1], float(size))
            weight[ends - 1] = np.array(sizes) - (lengths - 1) * size
            total = np.add.reduceat(window_scores(net, np.concatenate(windows)) * weight[:, None], ends - lengths)
            mean = np.exp(log_softmax(total / np.array(sizes)[:, None]))
            label[rows] = np.array(net.languages, object)[mean.argmax(axis=1)]
            score[rows] = mean.max(axis=1)

        for i in np.flatnonzero(lettered):
            data = texts[i].encode()
            rows.append(i), windows.append(cut_windows(data, size)), sizes.append(len(data))
            held += len(data)
            if held > 1_000_000:
                settle()
                rows, windows, sizes, held = [], [], [], 0
        if rows:
            settle()
        kept = {name: batch.column(name) for name in keep}
        return kept | {"lang_pred": label.tolist(), "score": score}

    return map_batches(docs.select(*dict.fromkeys([*keep, "text"])), transform, ddl)
