"""Near-duplicate documents by circulant MinHash.

A document is its set of word shingles. Two permutations of the 32-bit numbers give all signature coordinates: the first one
scatters the shingles, the second one, circularly shifted by k, gives coordinate k as the smallest image. Coordinates are
banded; documents that share a band are candidates and are confirmed by the exact Jaccard similarity of the words of
their whole texts.

Equal shingle sets are one node from the start, so exact copies never meet each other. Within a band the nodes
are compared with one leader by their full sets, linked nodes become one component, and only bands that still hold several components
go on. There the nodes outside the band's largest component meet all nodes of the band, in blocks of bounded volume: first by signature, which leaves
the nodes with a partner that looks similar enough, then by full sets. A block tests its pairs where they meet and
gives a forest over components, so what it emits is linear in its nodes, however many pairs are near or linked. Pairs inside one component
are never tested. With 40 bands of 5 coordinates, two sets of similarity 0.8 share no band with probability 1.3e-7; that their signatures
agree ``deviations`` standard deviations less than expected has probability 3e-6.

Sets, their sizes and digests hold 64-bit shingle hashes (two of a document's n shingles collide with probability n*n/2^65).

Defined results: a text without words, or null, has the empty set, is linked with nothing and is kept. Texts of any length are hashed whole. A
component keeps one row: that with the smallest id, null ids last, then the smallest text hash, then the first of equal rows. A null id
takes no part in the smallest id; if a component has no other id, component_id is null. Extra columns are ignored; an empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicstream.llm.common import bitmap, bitmap_size, in_bitmap, map_batches, mix64, text_bytes
from topicstream.llm.components import connected_components
from topicstream.session import staged_table


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    percent: int = 80  # link at 100 * intersection >= percent * union
    bands: int = 40
    rows: int = 5
    deviations: float = 4.5
    block: int = 1_000_000  # shingles of the nodes in a block, each node counted as 250 more
    most_bits: int = 1 << 27  # bound of the bitmap of nodes whose sets are needed: 16 MB
    crowd: int = 512  # pairs of one leader that a task gets together
    cached_words: int = 150_000


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_hashes(text: bytes, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; a shorter text is one shingle, an empty one has none. Only A-Z is lower-cased."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    size = min(size, n)
    total = h[: n - size + 1].copy()
    for i in range(1, size):
        total = mix64(total) + h[i : n - size + 1 + i]
    return np.unique(mix64(total + np.uint64(size)))


def scatter(x: np.ndarray) -> np.ndarray:
    """The first permutation of the 32-bit numbers."""
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    x = (x ^ (x >> np.uint32(12))) * np.uint32(0x297A2D39)
    return x ^ (x >> np.uint32(15))


def permute(x: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """The second permutation, in place."""
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        np.right_shift(x, np.uint32(shift), out=spare)
        x ^= spare
        x *= np.uint32(factor)
    np.right_shift(x, np.uint32(16), out=spare)
    x ^= spare
    return x


def signatures(values: np.ndarray, starts: np.ndarray, coordinates: int, block: int = 16384) -> np.ndarray:
    """(sets, coordinates) smallest images; ``values`` holds the 32-bit shingles of non-empty sets one after another."""
    ends = np.append(starts[1:], len(values))
    out = np.full((len(starts), coordinates), 0xFFFFFFFF, np.uint32)
    base = scatter(values)
    for lo in range(0, len(values), block):
        hi = min(lo + block, len(values))
        first = int(np.searchsorted(ends, lo, side="right"))
        last = int(np.searchsorted(starts, hi, side="left"))
        cuts = np.maximum(starts[first:last], lo) - lo
        piece, spare, image = base[lo:hi], np.empty(hi - lo, np.uint32), np.empty(hi - lo, np.uint32)
        part = np.empty((coordinates, last - first), np.uint32)
        for k in range(coordinates):
            np.add(piece, np.uint32(k), out=image)  # the circular shift: modulo 2^32
            part[k] = np.minimum.reduceat(permute(image, spare), cuts)
        np.minimum(out[first:last], part.T, out=out[first:last])
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band."""
    parts = signature.reshape(len(signature), bands, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2])
    for i in range(rows):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return key


def row_name() -> list[Column]:
    """Two hashes that name a row by its id, null included, and its text."""
    return [F.xxhash64(F.lit(11), "doc_id").alias("id_hash"), F.xxhash64("text").alias("text_hash")]


def sketch(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, row, id_hash, text_hash, n_shingles, digest of the set (null if empty), band keys and the low bytes of the signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts = text_bytes(batch.column("text"))
            at = 0
            while at < len(texts):  # a bounded number of bytes at a time
                upto, held = at, 0
                while upto < len(texts) and (upto == at or held + len(texts[upto]) <= 4_000_000):
                    held += len(texts[upto])
                    upto += 1
                yield part(batch.slice(at, upto - at), texts[at:upto], hashes)
                at = upto
                if len(hashes) > settings.cached_words:
                    hashes.clear()

    def part(batch: pa.RecordBatch, texts: list[bytes], hashes: WordHashes) -> pa.RecordBatch:
        sets = [shingle_hashes(t, settings.shingle, hashes) for t in texts]
        sizes = np.array([len(s) for s in sets])
        full = np.flatnonzero(sizes)
        keys, marks = np.empty((0, settings.bands), np.uint64), [None] * len(texts)
        if len(full):
            values = (np.concatenate([sets[i] for i in full]) >> np.uint64(32)).astype(np.uint32)
            starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
            signature = signatures(values, starts, settings.bands * settings.rows)
            keys = band_keys(signature, settings.bands, settings.rows)
            for i, row in zip(full, signature.astype(np.uint8), strict=True):
                marks[i] = row.tobytes()
        offsets = np.concatenate([[0], np.cumsum(np.where(sizes > 0, settings.bands, 0))]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel().view(np.int64)))
        digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
        columns = [batch.column(c) for c in ("doc_id", "row", "id_hash", "text_hash")]
        columns += [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), lists, pa.array(marks, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "id_hash", "text_hash", "n_shingles", "digest", "bands", "marks"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, row long, id_hash long, text_hash long, n_shingles long, digest binary, bands array<long>, marks binary"
    named = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), *row_name(), "text")
    return named.mapInArrow(run, ddl)


def full_sets(docs: DataFrame, wanted: DataFrame, settings: Settings) -> DataFrame:
    """digest and whole set, packed, of the rows of ``docs`` (doc_id, text) that ``wanted`` (id_hash, text_hash, digest) names.

    A bitmap of the names, of a bounded size, goes to the tasks, so texts of other rows are neither hashed nor shuffled, but for a few.
    """
    name = F.xxhash64("id_hash", "text_hash").alias("name")
    bits = bitmap_size(wanted.count(), 64, settings.most_bits)
    sieve = docs.sparkSession.sparkContext.broadcast(bitmap(wanted.select(name), "name", bits))
    hashes = WordHashes()

    def transform(batch: pa.RecordBatch) -> dict:
        batch = batch.filter(pa.array(in_bitmap(sieve.value, batch.column("name").to_numpy().view(np.uint64))))
        packed = []
        for text in text_bytes(batch.column("text")):
            packed.append(shingle_hashes(text, settings.shingle, hashes).tobytes())
            if len(hashes) > settings.cached_words:
                hashes.clear()
        return {c: batch.column(c) for c in named} | {"shingles": packed}

    named = ["id_hash", "text_hash"]
    rows = docs.select(*row_name(), "text").select(*named, name, "text")
    found = map_batches(rows, transform, "id_hash long, text_hash long, shingles binary")
    return found.join(wanted, named).dropDuplicates([*named, "digest"]).select("digest", "shingles")


def confirm(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) of digests whose full sets reach the similarity. ``sets``: digest, shingles.

    A leader with many pairs has its set in as many places as its pairs fill.
    """
    crowds = pairs.groupBy("a").agg(F.ceil(F.count("*") / settings.crowd).cast("int").alias("places"))
    salt = F.pmod(F.xxhash64("b"), F.col("places")).cast("int").alias("salt")
    left = pairs.join(crowds, "a").select("a", "b", salt).join(sets.select(F.col("digest").alias("b"), F.col("shingles").alias("of_b")), "b")
    right = crowds.join(sets.select(F.col("digest").alias("a"), F.col("shingles").alias("of_a")), "a")
    right = right.select("a", "of_a", F.explode(F.sequence(F.lit(0), F.col("places") - 1)).alias("salt"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = batch.column("of_a").to_pylist(), batch.column("of_b").to_pylist()
            good = []
            for i, (x, y) in enumerate(zip(first, second, strict=True)):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                if 100 * common >= settings.percent * (len(x) + len(y) - common):
                    good.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(good, pa.int64())) for c in ("a", "b")], ["a", "b"])

    both = left.join(right, ["a", "salt"]).select("a", "b", "of_a", "of_b")
    return both.mapInArrow(run, "a binary, b binary")


GROUP = ["key", "o", "s"]  # a band, a block of its open nodes, a block of all its nodes


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one group after another, from sorted batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        name = np.stack([batch.column(c).to_numpy() for c in GROUP])
        cuts = [0, *(np.flatnonzero((name[:, 1:] != name[:, :-1]).any(axis=0)) + 1), batch.num_rows]
        if held and [held[0].column(c)[0] for c in GROUP] != [batch.column(c)[0] for c in GROUP]:
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def objects(table: pa.Table, column: str) -> np.ndarray:
    out = np.empty(table.num_rows, object)
    out[:] = table.column(column).to_pylist()
    return out


def candidates(group: dict[str, np.ndarray], settings: Settings) -> np.ndarray:
    """The rows of a block pair with a partner that looks similar enough and belongs to another component.

    Rows that ask are open nodes, the others are all nodes of the band; two open nodes are tested once, and a pair in the first band it shares only.
    """
    share, coordinates = settings.percent / 100, group["marks"].shape[1]
    least = share - settings.deviations * np.sqrt(share * (1 - share) / coordinates)
    asking, stored = np.flatnonzero(group["asks"]), np.flatnonzero(~group["asks"])
    rank = np.unique(group["digest"], return_inverse=True)[1]
    which = np.unique(group["component"], return_inverse=True)[1]
    n, marks, bands, opened, chosen = group["n"], group["marks"], group["bands"], group["open"], np.zeros(len(rank), bool)
    for lo in range(0, len(asking), 64):
        x = asking[lo : lo + 64]
        for at in range(0, len(stored), 256):
            y = stored[at : at + 256]
            small, large = np.minimum(n[x, None], n[y]), np.maximum(n[x, None], n[y])
            good = (which[x, None] != which[y]) & (100 * small >= settings.percent * large) & (~opened[y] | (rank[x, None] < rank[y]))
            i, j = np.nonzero(good)
            if not len(i):
                continue
            if len(i) * 4 > good.size:
                agree = (marks[x, None] == marks[None, y]).mean(axis=2)[i, j]
            else:
                agree = (marks[x[i]] == marks[y[j]]).mean(axis=1)
            i, j = x[i[agree >= least]], y[j[agree >= least]]
            shared = bands[i] == bands[j]
            here = bands[i, shared.argmax(axis=1)] == group["key"]
            chosen[i[here]] = chosen[j[here]] = True
    return chosen


def forest(component: np.ndarray, asks: np.ndarray, sets: list[np.ndarray], settings: Settings) -> list[tuple[bytes, bytes]]:
    """True links between rows that ask and the others, as a forest over their components."""
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    asking, stored = np.flatnonzero(asks), np.flatnonzero(~asks)
    sizes = np.array([len(s) for s in sets])
    kinds, code = np.unique(component, return_inverse=True)
    # places of every shingle among the stored sets
    values = np.concatenate([sets[i] for i in stored])
    owner = np.repeat(np.arange(len(stored)), sizes[stored])
    turn = np.argsort(values, kind="stable")
    values, owner = values[turn], owner[turn]
    found = []
    for q in asking:
        lo, hi = np.searchsorted(values, sets[q], "left"), np.searchsorted(values, sets[q], "right")
        counts = hi - lo
        total = int(counts.sum())
        if not total:
            continue
        at = np.arange(total) + np.repeat(lo - (np.cumsum(counts) - counts), counts)
        common = np.bincount(owner[at], minlength=len(stored))
        good = 100 * common >= settings.percent * (sizes[q] + sizes[stored] - common)
        for other in np.unique(code[stored[good]]):
            x, y = root(component[q]), root(kinds[other])
            if x != y:
                parent[x] = y
                found.append((component[q], kinds[other]))
    return found


def met_in_blocks(opened: DataFrame, nodes: DataFrame, settings: Settings) -> DataFrame:
    """Rows (key, digest, n, component) of bands with several components, dealt to block pairs; ``nodes`` has more columns per digest."""
    weight = F.col("n") + 250
    parts = opened.groupBy("key", "component").agg(F.count("*").alias("c"), F.sum(weight).alias("w"))
    bands = parts.groupBy("key").agg(F.max(F.struct("c", "component", "w")).alias("big"), F.sum("w").alias("w"), F.count("*").alias("parts"))
    number = lambda w: F.ceil(w / settings.block).cast("int")
    bands = bands.filter("parts > 1").select(
        "key", F.col("big.component").alias("largest"), number(F.col("w") - F.col("big.w")).alias("of_open"), number(F.col("w")).alias("of_all")
    )
    block = lambda seed, count: F.pmod(F.xxhash64(F.lit(seed), "digest"), F.col(count)).cast("int")
    every = lambda count: F.sequence(F.lit(0), F.col(count) - 1)
    role = lambda o, s, asks: F.struct(o.alias("o"), s.alias("s"), F.lit(asks).alias("asks"))
    as_stored = F.transform(every("of_open"), lambda o: role(o, block(2, "of_all"), False))
    as_asking = F.transform(every("of_all"), lambda s: role(block(1, "of_open"), s, True))
    rows = opened.join(bands, "key").withColumn("open", F.col("component") != F.col("largest"))
    roles = F.explode(F.when(F.col("open"), F.concat(as_stored, as_asking)).otherwise(as_stored)).alias("role")
    dealt = rows.select("key", "digest", "n", "component", "open", roles).join(nodes, "digest")
    return dealt.select("key", "role.*", "digest", "n", "component", "open", *[c for c in nodes.columns if c != "digest"])


def likely(dealt: DataFrame, settings: Settings) -> DataFrame:
    """The rows of each block pair that may have a link there: key, o, s, asks, digest, component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches):
            group = {c: table.column(c).to_numpy() for c in ("n", "asks", "open")} | {c: objects(table, c) for c in ("digest", "component")}
            group["marks"] = np.frombuffer(b"".join(table.column("marks").to_pylist()), np.uint8).reshape(table.num_rows, -1)
            group["bands"] = table.column("bands").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)
            group["key"] = table.column("key")[0].as_py()
            chosen = candidates(group, settings)
            if chosen.any():
                yield from table.filter(pa.array(chosen)).select(kept).combine_chunks().to_batches()

    kept = [*GROUP, "asks", "digest", "component"]
    rows = dealt.repartition(*GROUP).sortWithinPartitions(*GROUP)
    return rows.mapInArrow(run, "key long, o int, s int, asks boolean, digest binary, component binary")


def linked_components(asked: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Links (a, b) between components, confirmed by full sets inside each block pair; fewer than the block pair has rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches):
            full = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
            found = forest(objects(table, "component"), table.column("asks").to_numpy(), full, settings)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*found, strict=True)], ["a", "b"])

    rows = asked.join(sets, "digest").select(*GROUP, "asks", "component", "shingles")
    return rows.repartition(*GROUP).sortWithinPartitions(*GROUP).mapInArrow(run, "a binary, b binary")


def shared_bands(sets: DataFrame, settings: Settings) -> DataFrame:
    """key, digest, n for the bands of ``sets`` that more than one node has, and a few others.

    Only keys are shuffled to be counted; a bitmap of those that are shared, of a bounded size, then sorts out the others in the tasks.
    """
    keys = sets.select(F.explode("bands").alias("key")).groupBy("key").agg(F.count("*").alias("c")).filter("c > 1")
    keys = staged_table(keys.select("key"), "minhash-keys")
    bits = bitmap_size(keys.count(), 64, settings.most_bits)
    sieve = sets.sparkSession.sparkContext.broadcast(bitmap(keys, "key", bits))

    def transform(batch: pa.RecordBatch) -> dict | None:
        bands = batch.column("bands")
        key = bands.flatten().to_numpy()
        owner = np.repeat(np.arange(batch.num_rows), np.diff(bands.offsets.to_numpy()))
        good = in_bitmap(sieve.value, key.view(np.uint64))
        at = pa.array(owner[good])
        return {"key": key[good], "digest": batch.column("digest").take(at), "n": batch.column("n").take(at)}

    return map_batches(sets.select("digest", F.col("n_shingles").alias("n"), "bands"), transform, "key long, digest binary, n long")


def components(members: DataFrame, leaders: DataFrame, sets: DataFrame, nodes: DataFrame, settings: Settings) -> DataFrame:
    """Component of every node with a link: node, component.

    ``members``: key, digest, n. ``leaders``: key, a, m. ``sets``: digest, shingles. ``nodes``: digest, marks, bands.
    """
    similar = F.expr(f"100 * least(n, m) >= {settings.percent} * greatest(n, m)")
    pairs = members.join(leaders, "key").filter(similar & (F.col("digest") > F.col("a")))
    pairs = staged_table(pairs.select("a", F.col("digest").alias("b")).distinct(), "minhash-pairs")
    links = staged_table(confirm(pairs, sets, settings), "minhash-links")
    component = staged_table(connected_components(links), "minhash-components")

    opened = members.join(component, members.digest == component.node, "left")
    opened = opened.select("key", "digest", "n", F.coalesce("component", "digest").alias("component"))
    mixed = opened.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y")
    opened = staged_table(opened.join(mixed.select("key"), "key"), "minhash-open")
    asked = staged_table(likely(met_in_blocks(opened, nodes, settings), settings), "minhash-asked")
    more = staged_table(linked_components(asked, sets, settings).distinct(), "minhash-more")
    joined = staged_table(connected_components(more), "minhash-joined").select(F.col("node").alias("component"), F.col("component").alias("whole"))
    first = component.join(joined, "component", "left").select("node", F.coalesce("whole", "component").alias("component"))
    lone = joined.join(component.select(F.col("node").alias("component")), "component", "left_anti")
    return first.union(lone.select(F.col("component").alias("node"), F.col("whole").alias("component")))


def marked_rows(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` (doc_id, text) to one row per document: doc_id, id_hash, text_hash, n_shingles, component_id, kept."""
    marked = staged_table(sketch(docs, settings), "minhash-sketch")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash", "row")
    node = F.min(F.struct(order.alias("at"), "id_hash", "n_shingles", "bands", "marks")).alias("r")
    sets = marked.filter("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("first_id"), node)
    sets = staged_table(sets.select("digest", "first_id", "r.*"), "minhash-sets")

    rows = staged_table(shared_bands(sets, settings), "minhash-shared")
    leaders = rows.groupBy("key").agg(F.count("*").alias("c"), F.min(F.struct("digest", "n")).alias("l")).filter("c > 1")
    leaders = staged_table(leaders.select("key", F.col("l.digest").alias("a"), F.col("l.n").alias("m")), "minhash-leaders")
    members = staged_table(rows.join(leaders.select("key"), "key"), "minhash-bands")
    met = members.select("digest").distinct().join(sets.select("digest", "id_hash", F.col("at.text_hash").alias("text_hash")), "digest")
    full = staged_table(full_sets(docs, staged_table(met, "minhash-met"), settings), "minhash-full")
    component = components(members, leaders, full, sets.select("digest", "marks", "bands"), settings)

    node = sets.join(component, sets.digest == component.node, "left")
    node = node.select("digest", "first_id", "at", F.coalesce("component", "digest").alias("component"))
    least = node.groupBy("component").agg(F.min("first_id").alias("component_id"), F.min("at").alias("first"))
    of_set = node.join(least, "component").select("digest", "component_id", F.col("first.row").alias("first_row"))
    out = marked.select("doc_id", "row", "id_hash", "text_hash", "n_shingles", "digest").join(of_set, "digest", "left")
    empty = F.col("digest").isNull()
    return out.select(
        "doc_id", "id_hash", "text_hash", "n_shingles",
        F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), (empty | (F.col("row") == F.col("first_row"))).alias("kept"),
    )


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` (doc_id, text) to one row per document: doc_id, n_shingles, component_id, kept."""
    return marked_rows(docs, settings).select("doc_id", "n_shingles", "component_id", "kept")
