"""Bigram language model in a log-frequency Bloom filter.

Counting: every task counts the tokens and the pairs of following tokens of its training texts in runs and sends them on packed by
hash range. One group per range adds them up. Ranges of tokens become exact count tables; ranges of pairs become segments of the
filter: a pair with count c is entered once for each level 1 .. 1 + floor(log_base c). A level is a set of bits in the pair's segment.
A segment has ``entry_bits`` bits or more for each level entered in it, and their number grows with the texts, so neither the rate of
false levels nor the size of one segment depends on the size of the corpus.

Scoring: documents are dealt into blocks. Blocks ask the count tables for their distinct tokens and the segments for their distinct pairs,
and answers meet the documents by block; nothing is broadcast. A pair's level is found by probing level after level until one is missing or
the highest of the segment is reached; the middle of that level's counts estimates its count, at most the exact counts of its tokens. Dirichlet
smoothing with the unigram probability gives (count(pair) + mass * p(token)) / (count(first) + mass).

Tokens are known by 64-bit hashes, pairs by their segment and 32 bits more.

Defined results: null text is empty, which is the end token alone. With no training text N is 0 and every probability is 1. Repeated rows are
counted and scored one by one. Extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicstream.llm.common import mix64, text_bytes, text_volume
from topicstream.session import staged_table

END, BEGIN = np.uint64(xxhash.xxh3_64_intdigest(b"", seed=1)), np.uint64(xxhash.xxh3_64_intdigest(b"", seed=2))
TOKENS, PAIRS = 1, 2


@dataclass(frozen=True)
class Settings:
    base: float = 1.5
    hashes: int = 5
    segments: int = 4096  # a power of two; more if a segment would stand for more than block_bytes of text
    least_bytes: int = 1 << 21
    entry_bits: int = 10  # for each level entered, before rounding up to a power of two
    block_bytes: int = 5 << 20
    run_tokens: int = 1_500_000
    mass: float = 8.0
    cached_words: int = 200_000


def powers(n: float) -> int:
    return 1 << max(0, int(np.ceil(np.log2(max(1.0, n)))))


class Words(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def tokens(text: bytes, words: Words) -> np.ndarray:
    """Hashes of the words (A-Z lower-cased, split at ASCII blanks) and the end."""
    found = text.lower().split()
    out = np.empty(len(found) + 1, np.uint64)
    out[:-1] = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    out[-1] = END
    return out


def pair_keys(stream: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First tokens (the begin mark at ``starts``) and hashes of ``width`` bits of the pairs that end at each token."""
    first = np.empty_like(stream)
    first[1:] = stream[:-1]
    first[starts] = BEGIN
    return first, mix64(mix64(first) + stream) >> np.uint64(64 - width)


def packed_runs(kind: int, keys: np.ndarray, counts: np.ndarray, parts: int, width: int) -> dict:
    """Sorted keys of ``width`` bits cut into ``parts`` ranges: kind, part, keys and counts as bytes."""
    shift = np.uint64(width - int(np.log2(parts)))
    part = (keys >> shift).astype(np.int64)
    cuts = np.flatnonzero(np.diff(part, prepend=-1))
    low = keys & np.uint64((1 << int(shift)) - 1) if shift < 64 else keys
    low = low.astype("<u4" if kind == PAIRS else "<u8")
    number = counts.astype("<u4")
    ends = [*cuts[1:], len(keys)]
    return {
        "kind": [kind] * len(cuts),
        "part": part[cuts],
        "keys": [low[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)],
        "counts": [number[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)],
    }


def add_up(keys: list[bytes], counts: list[bytes], kind: str) -> tuple[np.ndarray, np.ndarray]:
    key, back = np.unique(np.frombuffer(b"".join(keys), kind), return_inverse=True)
    return key, np.bincount(back, np.frombuffer(b"".join(counts), "<u4"), len(key)).astype(np.int64)


def places(key: np.ndarray, level: int, hashes: int, bits: int) -> Iterator[np.ndarray]:
    """The bits of one level of pairs, within the pair's segment."""
    h = mix64(key.astype(np.uint64) + np.uint64(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    step = (h >> np.uint64(32)) | np.uint64(1)
    for i in range(hashes):
        yield ((h + np.uint64(i) * step) & np.uint64(bits - 1)).astype(np.int64)


def pair_levels(counts: np.ndarray, base: float) -> np.ndarray:
    """The levels at which pairs are entered, as the number of the highest one."""
    return 1 + np.floor(np.log(counts) / np.log(base) + 1e-9).astype(np.int64)


def enter(keys: np.ndarray, counts: np.ndarray, bits: int, settings: Settings) -> np.ndarray:
    """Bytes of one segment; ``keys`` are the 32 low bits of the pairs."""
    level = pair_levels(counts, settings.base)
    marks = np.zeros(bits, np.uint8)
    for j in range(1, int(level.max(initial=0)) + 1):
        for at in places(keys[level >= j], j, settings.hashes, bits):
            marks[at] = 1
    return np.packbits(marks, bitorder="little")


def levels(keys: np.ndarray, bloom: np.ndarray, settings: Settings, highest: float = np.inf) -> np.ndarray:
    """The level of every pair hash: repeated probes until one misses; no level above ``highest`` was entered."""
    bits = len(bloom) * 8 // settings.segments
    segment = (keys >> np.uint64(32)).astype(np.int64) * bits
    low = keys & np.uint64(0xFFFFFFFF)
    level, left, j = np.zeros(len(keys), np.int64), np.arange(len(keys)), 1
    while len(left) and j <= highest:
        hit = np.ones(len(left), bool)
        for at in places(low[left], j, settings.hashes, bits):
            place = segment[left] + at
            hit &= (bloom[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
        left = left[hit]
        level[left] = j
        j += 1
    return level


def expected_counts(level: np.ndarray, base: float) -> np.ndarray:
    """The middle of the counts of a level; 0 for none."""
    low, high = np.ceil(base ** (level - 1.0) - 1e-9), np.ceil(base ** level.astype(float) - 1e-9) - 1
    return np.where(level > 0, (low + np.maximum(low, high)) / 2, 0.0)


@dataclass
class Model:
    tables: DataFrame  # kind, part, keys, counts: exact token counts by hash range; segments (bits, highest level) of the filter
    parts: int
    segments: int
    tokens: int
    distinct: int
    documents: int


def fit(docs: DataFrame, trainable: Column, settings: Settings = Settings()) -> Model:
    """Learn from the texts of rows where ``trainable`` holds."""
    texts = docs.filter(trainable).select("text")
    volume = text_volume(texts, "text")
    parts = powers(volume / settings.block_bytes)
    segments = max(settings.segments, parts)
    least, width = max(8, powers(settings.least_bytes * 8 / segments)), 32 + int(np.log2(segments))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held, size = Words(), [], 0

        def settle() -> Iterator[pa.RecordBatch]:
            stream = np.concatenate(held)
            starts = np.cumsum([0] + [len(x) for x in held[:-1]])
            for kind, keys, cut, bits in ((TOKENS, stream, parts, 64), (PAIRS, pair_keys(stream, starts, width)[1], segments, width)):
                run = packed_runs(kind, *np.unique(keys, return_counts=True), cut, bits)
                yield pa.RecordBatch.from_pydict(run, schema=packed)

        for batch in batches:
            for text in text_bytes(batch.column("text")):
                held.append(tokens(text, words))
                size += len(held[-1])
                if size >= settings.run_tokens:
                    yield from settle()
                    held, size = [], 0
                if len(words) > settings.cached_words:
                    words.clear()
        if held:
            yield from settle()

    packed = pa.schema([("kind", pa.int32()), ("part", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])

    def merge(key: tuple, group: pa.Table) -> pa.Table:
        kind, part = key[0].as_py(), key[1].as_py()
        columns = group.column("keys").to_pylist(), group.column("counts").to_pylist()
        keys, counts = add_up(*columns, "<u4" if kind == PAIRS else "<u8")
        if kind == PAIRS:
            level = pair_levels(counts, settings.base)
            bits = max(least, powers(settings.entry_bits * int(level.sum())))
            content = [enter(keys, counts, bits, settings).tobytes()], [level.max().astype("<i8").tobytes()]
        else:
            content = [keys.astype("<u8").tobytes()], [counts.astype("<i8").tobytes()]
        high = np.uint64(part) << np.uint64(64 - int(np.log2(parts))) if parts > 1 else np.uint64(0)
        ends = int(counts[keys == END - high].sum()) if kind == TOKENS and END >= high else 0
        return pa.table([[kind], [part], *content, [int(counts.sum())], [len(keys)], [ends]], schema=merged)

    merged = packed.append(pa.field("total", pa.int64())).append(pa.field("distinct", pa.int64())).append(pa.field("ends", pa.int64()))
    ddl = "kind int, part long, keys binary, counts binary"
    runs = texts.mapInArrow(count, ddl)
    table = runs.groupBy("kind", "part").applyInArrow(merge, ddl + ", total long, distinct long, ends long")
    table = staged_table(table, "lm-counts")
    total = table.filter(F.col("kind") == TOKENS).agg(F.sum("total"), F.sum("distinct"), F.sum("ends")).head()
    return Model(table.select("kind", "part", "keys", "counts"), parts, segments, *[x or 0 for x in total])


def score(docs: DataFrame, model: Model, keep: list[str], settings: Settings = Settings()) -> DataFrame:
    """``keep`` columns plus n_tokens, n_known, train_tokens, base_score and score of every text."""
    blocks = max(1, -(-text_volume(docs, "text") // settings.block_bytes))
    block = F.pmod(F.xxhash64("text", *keep), F.lit(blocks)).alias("block")
    dealt = docs.select(block, *keep, "text").repartition(blocks, "block")
    parts, segments, N, V, documents = model.parts, model.segments, model.tokens, model.distinct, model.documents
    width, of_segment = 32 + int(np.log2(segments)), replace(settings, segments=1)

    def streams(table: pa.Table) -> list[np.ndarray]:
        words = Words()
        return [tokens(t, words) for chunk in table.column("text").chunks for t in text_bytes(chunk)]

    def joined(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lengths = np.array([len(x) for x in held])
        return np.concatenate(held), lengths, np.cumsum(lengths) - lengths

    def ask(key: tuple, group: pa.Table) -> pa.Table:
        stream, _, starts = joined(streams(group))
        out = []
        for kind, keys, cut, bits in ((TOKENS, stream, parts, 64), (PAIRS, pair_keys(stream, starts, width)[1], segments, width)):
            keys = np.unique(keys)
            run = packed_runs(kind, keys, np.zeros(len(keys)), cut, bits)
            columns = [pa.array([key[0].as_py()] * len(run["part"]), pa.int64()), pa.array(run["kind"], pa.int32()), pa.array(run["part"], pa.int64())]
            out.append(pa.table([*columns, pa.array(run["keys"], pa.binary())], ["block", "kind", "part", "keys"]))
        return pa.concat_tables(out)

    def token_counts(wanted: np.ndarray, known: np.ndarray, counts: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
        return np.where(known[at] == wanted, counts[at], 0)

    def answer(key: tuple, known: pa.Table, questions: pa.Table) -> pa.Table:
        of_pairs = key[0].as_py() == PAIRS
        wanted = [np.frombuffer(k, "<u4" if of_pairs else "<u8") for k in questions.column("keys").to_pylist()]
        ends = np.cumsum([len(x) for x in wanted])
        every, found = np.concatenate([*wanted, []], dtype=np.uint64, casting="unsafe"), np.zeros(sum(map(len, wanted)), np.int64)
        for keys, counts in zip(known.column("keys").to_pylist(), known.column("counts").to_pylist(), strict=True):  # one or none
            counts = np.frombuffer(counts, "<i8")
            if of_pairs:
                found = levels(every, np.frombuffer(keys, np.uint8), of_segment, counts[0])
            else:
                found = token_counts(every, np.frombuffer(keys, "<u8"), counts)
        out = [x.astype("<i4" if of_pairs else "<i8").tobytes() for x in np.split(found, ends[:-1])] if wanted else []
        columns = {c: questions.column(c) for c in ("block", "kind", "part")}
        return pa.table({**columns, "counts": pa.array(out, pa.binary())})

    def weigh(key: tuple, group: pa.Table, answers: pa.Table) -> pa.Table:
        stream, lengths, starts = joined(streams(group))
        answers = answers.sort_by("part")
        kinds, told = answers.column("kind").to_pylist(), answers.column("counts").to_pylist()
        of_key, of_pair = (np.frombuffer(b"".join(x for k, x in zip(kinds, told, strict=True) if k == kind), n) for kind, n in ((TOKENS, "<i8"), (PAIRS, "<i4")))
        keys, back = np.unique(stream, return_inverse=True)
        count = of_key[back].astype(float)
        plain = (count + 0.5) / (N + 0.5 * (V + 1))
        first, pairs = pair_keys(stream, starts, width)
        context = np.append(0.0, count[:-1])
        context[starts] = documents
        _, which = np.unique(pairs, return_inverse=True)
        seen = expected_counts(of_pair, settings.base)[which]
        seen = np.minimum(seen, np.minimum(context, count))
        smoothed = (seen + settings.mass * plain) / (context + settings.mass)
        add = lambda x: np.add.reduceat(x, starts)
        columns = {name: group.column(name) for name in keep}
        return pa.table(
            columns
            | {
                "n_tokens": lengths.astype(np.int64),
                "n_known": add((count > 0).astype(np.int64)),
                "train_tokens": np.full(len(lengths), N, np.int64),
                "base_score": add(np.log10(plain)),
                "score": add(np.log10(smoothed)),
            }
        )

    questions = dealt.groupBy("block").applyInArrow(ask, "block long, kind int, part long, keys binary")
    by_range = model.tables.groupBy("kind", "part").cogroup(questions.groupBy("kind", "part"))
    told = by_range.applyInArrow(answer, "block long, kind int, part long, counts binary")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    ddl = kinds + ", n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return dealt.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(weigh, ddl)
