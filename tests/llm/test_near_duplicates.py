"""MinHash, product quantisation, spot signatures and components against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicstream.llm import minhash, pq, spotsigs
from topicstream.llm.components import connected_components


def components_of(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {n: root(n) for n in nodes}


def test_components_of_chains_stars_and_nothing(llm):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    rows = llm.createDataFrame(links + [(7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in connected_components(rows).collect()}
    want = components_of({x for p in links for x in p}, links)
    assert got == {n: c for n, c in want.items() if n in got} and {n for a, b in links for n in (a, b) if a != b} == set(got)
    assert connected_components(rows.limit(0)).count() == 0


def family(rng, words, size, edits):
    base = [rng.choice(words) for _ in range(rng.randint(12, 60))]
    for _ in range(size):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        yield " ".join(copy)


def shingled(text, size):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} if words else set()


@pytest.mark.parametrize("size", [2, 5])
def test_minhash_is_brute_force(docs_of, size):
    rng = random.Random(size)
    words = [f"Wörd{i}" for i in range(300)]
    texts = [t for n in (2, 3, 60) for _ in range(4) for t in family(rng, words, n, 6)]
    texts += ["", None, " \n ", "one", "ONE", "one two", "a b c", texts[0], texts[0], texts[0].upper().replace("Ö", "ö")]
    rows = list(enumerate(texts, 10))
    settings = minhash.Settings(shingle=size, block=5000, crowd=7)
    got = {r.doc_id: r for r in minhash.near_duplicates(docs_of(rows), settings).collect()}
    sets = {i: shingled(t, size) for i, t in rows}
    links = [
        (a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    want = components_of(sets, links)
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {
        i: (len(sets[i]), want[i], want[i] == i) for i in sets
    }


def test_minhash_keeps_one_row_of_repeated_rows_and_null_ids(docs_of):
    docs = docs_of([(5, "a b c"), (5, "a b c"), (None, "a b c"), (None, "x y"), (None, None), (3, "q r s"), (None, "u v"), (None, "U v")])
    got = minhash.near_duplicates(docs).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in got) == [
        (0, 0, False), (0, 0, True), (0, 0, True), (0, 0, True), (0, 5, False), (3, 3, True), (5, 5, False), (5, 5, True)
    ]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_minhash_of_very_long_texts(docs_of):
    rng = random.Random(3)
    long = [f"w{rng.randrange(50000)}" for _ in range(60000)]
    copy = [w if i % 80 else "changed" for i, w in enumerate(long)]
    other = [w if i % 4 else "changed" for i, w in enumerate(long)]
    got = {r.doc_id: r for r in minhash.near_duplicates(docs_of([(1, " ".join(long)), (2, " ".join(copy)), (3, " ".join(other)), (4, "x" * 300000)])).collect()}
    assert [got[i].component_id for i in (1, 2, 3, 4)] == [1, 1, 3, 4] and got[4].n_shingles == 1


@pytest.mark.parametrize("edits, size", [(2, 300), (4, 300), (4, 600)])
def test_block_pairs_emit_forests(llm, edits, size):
    """A family just over or just under the threshold: all pairs look similar, what leaves a block is linear in its nodes."""
    rng = random.Random(edits)
    base = [f"b{i}" for i in range(100)]
    texts = []
    for k in range(size):
        words = list(base)
        for at in rng.sample(range(0, 100, 2), edits):
            words[at] = f"own{k}x{at}"
        texts.append(" ".join(words))
    settings = minhash.Settings(shingle=2)
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = {t: shingled(t, 2) for t in texts}
    sketch = minhash.sketch(docs, settings).cache()
    opened = sketch.select(F.explode("bands").alias("key"), "digest", F.col("n_shingles").alias("n"), F.col("digest").alias("component"))
    dealt = minhash.met_in_blocks(opened, sketch.select("digest", "marks", "bands"), settings)
    asked = minhash.likely(dealt, settings).cache()
    full = minhash.full_sets(docs, sketch.select("id_hash", "text_hash", "digest"), settings)
    found = minhash.linked_components(asked, full, settings).collect()
    groups = asked.groupBy("key", "o", "s").agg(F.countDistinct("digest").alias("n")).collect()
    assert asked.count() <= dealt.count() and len(found) <= sum(g.n - 1 for g in groups)
    name = {r.digest: r.doc_id for r in sketch.collect()}
    links = [(name[bytes(r.a)], name[bytes(r.b)]) for r in found]
    every = [(a, b) for a in range(size) for b in range(a) if 100 * len(sets[texts[a]] & sets[texts[b]]) >= 80 * len(sets[texts[a]] | sets[texts[b]])]
    assert components_of(range(size), links) == components_of(range(size), every)
    assert (len(every) > 10 * size) == (edits == 2)
    assert len(links) < 40 * size


def test_circulant_coordinates_are_shifts_of_one_permutation():
    x = np.array([3, 99, 2**32 - 1], np.uint32)
    moved = lambda k: minhash.permute(minhash.scatter(x) + np.uint32(k), np.empty(3, np.uint32))
    got = minhash.signatures(x, np.array([0, 2]), 4, block=2)
    assert got.tolist() == [[int(moved(k)[:2].min()) for k in range(4)], [int(moved(k)[2]) for k in range(4)]]
    every = np.arange(65536, dtype=np.uint32) << np.uint32(16)
    assert len(np.unique(minhash.scatter(every))) == len(np.unique(minhash.permute(every.copy(), every.copy()))) == 65536


def test_embeddings_are_brute_force(llm):
    rng = np.random.default_rng(3)
    rows = []
    for c in range(6):
        base = rng.standard_normal(16)
        rows += [((base + rng.standard_normal(16) * 0.05 * (1 + c % 3)).tolist(), c % 2) for _ in range(40)]
    rows += [(rows[0][0], 0), (rows[0][0], 1), ([2 * x for x in rows[0][0]], 0), (rows[1][0], None)]
    rows += [(None, 0), ([], 0), ([0.0] * 16, 0), ([None] + [1.0] * 15, 0), ([float("nan")] * 16, 0), ([float("inf")] + [1.0] * 15, 0), ([1.0, 0.0], 0)]
    rows += [([1.0, 1e-3], 0)]
    table = llm.createDataFrame([(i, v, l, "k") for i, (v, l) in enumerate(rows)], "vec_id long, embedding array<double>, label int, key string")
    settings = pq.Settings(centres=5, codewords=16, sample=100, block=16)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in pq.near_duplicates(table, settings).collect()}
    good = {
        i: np.array(v) for i, (v, l) in enumerate(rows) if v and l is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
    }
    links = [
        (a, b) for a in good for b in good
        if a < b and rows[a][1] == rows[b][1] and len(good[a]) == len(good[b])
        and good[a] @ good[b] / np.sqrt(good[a] @ good[a]) / np.sqrt(good[b] @ good[b]) >= 0.98
    ]
    want = components_of(range(len(rows)), links)
    number = [sum(i in p for p in links) for i in range(len(rows))]
    assert got == {i: (number[i], want[i], want[i] == i) for i in range(len(rows))}
    assert sum(number) > 100
    assert pq.near_duplicates(table.limit(0)).count() == 0


def test_spots_of_a_text(llm):
    def keys(text):
        row = llm.createDataFrame([(text,)], "t string").select(spotsigs.spots(F.col("t")).alias("s")).head()
        return set(row.s)

    def hashed(*spots):
        rows = llm.createDataFrame([(s,) for s in spots], "t string").select(spotsigs.hash60(F.col("t")).alias("h"))
        return {r.h for r in rows.collect()}

    assert keys("At the Ritz, a dog and the cat is big") == hashed("the:ritz:dog", "a:dog:cat", "the:cat:big", "is:big")
    assert keys("Nothing common") == hashed("nothing", "common")
    assert keys("the of") == hashed("the", "of") and keys("") == hashed("") and keys("!?") == hashed("!?")


def test_fingerprints_of_next_and_edited(docs_of):
    long_text = " ".join(f"the w{i} and x{i}" for i in range(40))
    rows = [(9, long_text), (7, long_text + " end"), (5, None), (3, ""), (1, "the one"), (1, "the one")]
    got = spotsigs.compared(docs_of(rows)).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == 6 and by_id[9].near_next > 0.9 and 0.4 < by_id[9].near_edited <= 1
    assert by_id[5].fingerprint == by_id[3].fingerprint and by_id[5].near_next == 1.0 and by_id[5].n_chars == 0
    assert by_id[1].near_next == 0.0 and spotsigs.compared(docs_of(rows).limit(0)).count() == 0


def test_next_goes_around_over_ranges(llm, monkeypatch):
    monkeypatch.setattr(spotsigs, "ROWS_PER_RANGE", 5)
    rows = llm.createDataFrame([(i * 3, i, 1) for i in range(23)] + [(None, 1, 1)], "doc_id long, hash long, third int")
    got = {r.doc_id: r.next_id for r in spotsigs.with_next(rows).collect()}
    assert got == {0: None, None: 66} | {i * 3: i * 3 - 3 for i in range(1, 23)}


def test_spot_links_are_brute_force(docs_of):
    rng = random.Random(8)
    words = ["the", "a", "is", *[f"w{i}" for i in range(50)]]
    rows = list(enumerate(t for n in (2, 3, 12) for _ in range(3) for t in family(rng, words, n, 2)))
    marked = docs_of(rows).select("doc_id", spotsigs.spots(F.col("text")).alias("spots"))
    member, found = spotsigs.links(marked, 0.6)
    sets = {r.doc_id: frozenset(r.spots) for r in marked.collect()}
    by_set = {}
    for r in member.collect():
        by_set.setdefault(r.set_id, sets[r.doc_id])
    got = {frozenset((by_set[r.a], by_set[r.b])) for r in found.collect()}
    distinct = set(sets.values())
    want = {frozenset((x, y)) for x in distinct for y in distinct if x != y and len(x & y) >= 0.6 * len(x | y)}
    assert got == want and want
