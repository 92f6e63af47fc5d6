"""Lloyd codes, importance resampling and winnowing against one-by-one restatements."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from topicstream.llm import lloyd, resample, winnow

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


# ---- codes


def codes_of(rows, entries, rounds, parts=4):
    """rows: (vec_id, vector) of usable vectors, in the order of the first codebooks; plain Python integers."""
    width = max(len(v) for _, v in rows)
    width += -width % parts
    whole = [[math.floor(x * 1024) for x in v] + [0] * (width - len(v)) for _, v in rows]
    step = width // parts
    cut = [[w[p * step : (p + 1) * step] for w in whole] for p in range(parts)]
    books = [[list(x) for x in part[:entries]] for part in cut]

    def nearest(part, book):
        square = [[sum((a - b) ** 2 for a, b in zip(x, e)) for e in book] for x in part]
        return [min(range(len(s)), key=lambda i: (s[i], i)) for s in square], [min(s) for s in square]

    for _ in range(rounds):
        for p in range(parts):
            own, _ = nearest(cut[p], books[p])
            for e in range(len(books[p])):
                members = [x for x, o in zip(cut[p], own) if o == e]
                if members:
                    books[p][e] = [sum(c) // len(members) for c in zip(*members)]
    found = [nearest(cut[p], books[p]) for p in range(parts)]
    codes = ["".join(f"{found[p][0][i]:02x}" for p in range(parts)) for i in range(len(rows))]
    errors = [sum(found[p][1][i] for p in range(parts)) for i in range(len(rows))]
    return codes, errors, hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()


def vectors(n, width, seed, scale=1.0):
    rng = np.random.default_rng(seed)
    return [(rng.standard_normal(width) * scale).round(4).tolist() for _ in range(n)]


@pytest.mark.parametrize("scale", [1.0, 1e9])
def test_codes_are_plain_lloyd(llm, scale):
    """Beyond 2^53 the exact integers of Python take over; ties and repeated vectors included."""
    kept = vectors(40, 8, 4, scale) + [[scale] * 8] * 12
    rows = [(i * 7, v, i % 3 if i % 5 else None, "x") for i, v in enumerate(kept)]
    random.Random(1).shuffle(rows)
    odd = [(1, None, 0, "x"), (2, [1.0, None], 0, "x"), (3, [float("nan")] * 8, 1, "x"), (4, [float("-inf")] * 8, 1, "x")]
    table = llm.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int, row string")
    settings = lloyd.Settings(entries=6, rounds=3, members=4)
    got = {r.vec_id: r for r in lloyd.compress(table, settings).collect()}
    ordered = sorted((i, v) for i, v, _, _ in rows)
    codes, errors, digest = codes_of(ordered, 6, 3)
    label = {i: n for i, _, n, _ in rows}
    total = {}
    for (i, _), e in zip(ordered, errors):
        total[label[i]] = total.get(label[i], 0) + e
    most = (1 << 63) - 1
    assert set(got) == {i for i, _ in ordered} and any(errors)
    for (i, _), code, error in zip(ordered, codes, errors):
        row = got[i]
        assert (row.code, row.codebooks_sha256) == (code, digest)
        assert row.error == (error if error <= most else None)
        if scale == 1.0:
            assert row.label_error == total[label[i]]


def test_codes_of_odd_tables(llm):
    kinds = "vec_id long, embedding array<float>, label int, code string, position int"
    rows = [(None, [1.0, 2.0, 3.0], None, "c", 1), (5, [1.0, 2.0, 3.0, 0.0], 1, "c", 1), (5, [1.0, 2.0, 3.0, 0.0], 1, "c", 1), (6, [], 1, "c", 1)]
    got = lloyd.compress(llm.createDataFrame(rows, kinds)).collect()
    ordered = [(5, rows[1][1]), (5, rows[2][1]), (6, []), (None, rows[0][1])]
    codes, errors, digest = codes_of(ordered, 256, 4)
    assert sorted((r.vec_id or 99, r.code) for r in got) == sorted((i or 99, c) for (i, _), c in zip(ordered, codes))
    assert {r.codebooks_sha256 for r in got} == {digest} and sum(r.error for r in got) == sum(errors)
    assert lloyd.compress(llm.createDataFrame([], kinds)).count() == 0
    assert lloyd.compress(llm.createDataFrame([(1, None, 1, "c", 1)], kinds)).count() == 0


def test_only_parts_that_change_their_entry_are_shuffled(llm):
    """The union of members that stay and members that go has the partitions of both, so it adds no exchange."""
    place = lloyd.owner_partition(4)
    start = llm.sparkContext.parallelize([((0, i % 4, 0), (np.array([i]), np.array([[i]]))) for i in range(32)], 3)
    resident = start.partitionBy(5, place)
    books = [np.array([[0], [8], [16], [24]])]
    moved = lloyd.reassigned(resident, books)
    after = lloyd.settle(moved, {}, 5, place)
    assert after.getNumPartitions() == 5 and after.partitioner == resident.partitioner
    held = after.glom().collect()
    for number, records in enumerate(held):
        for owner, (ids, parts) in records:
            assert place(owner) % 5 == number
            assert lloyd.nearest(parts, books[0])[0].tolist() == [owner[1]] * len(parts)
    assert sum(len(ids) for records in held for _, (ids, _) in records) == 32


def test_hot_entries_have_many_owners(llm):
    rows = [(i, [0.5] * 4 if i % 3 else [i / 7] * 4, 0) for i in range(300)]
    table = llm.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    settings = lloyd.Settings(entries=8, members=16)
    assert lloyd.owners_needed({(0, 0): 200, (0, 1): 16}, settings) == {(0, 0): 13, (0, 1): 1}
    got = {r.vec_id: r.code for r in lloyd.compress(table, settings).collect()}
    codes, _, _ = codes_of([(i, v) for i, v, _ in rows], 8, 4)
    assert [got[i] for i in range(300)] == codes


# ---- resampling


def features_of(text):
    words = WORD.findall(lowered(text))
    return words, [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def resampled(docs, target, buckets=10000, least=20, percent=5):
    def counts(texts):
        out = [0] * buckets
        for t in texts:
            for f in features_of(t)[1]:
                out[zlib.crc32(f.encode()) % buckets] += 1
        return out

    s, t = counts(x for _, x in docs), counts(target)
    gain = [math.floor(1000 * math.log((b + 1.0) * (sum(s) + buckets) / ((a + 1.0) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for i, text in docs:
        words, found = features_of(text)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in found)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words) >= least))
    chosen = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    last = percent * len(chosen) // 100
    rank = {}
    for n, r in enumerate(chosen[:last], 1):
        rank.setdefault(r, []).append(n)
    return [(*r[:4], rank[r].pop(0) if rank.get(r) else None) for r in rows]


def prose(rng, n, words):
    return rng.choice([" ", ", ", "\n", " - "]).join(rng.choice(words) for _ in range(n))


def test_resampling_is_brute_force(llm, docs_of):
    rng = random.Random(5)
    words = [f"Wörd{i}" for i in range(40)] + ["THE", "of", "naïve", "日本", "x1", "ß"]
    docs = [(i, prose(rng, rng.choice([0, 1, 2, 3, 19, 20, 21, 60]), words)) for i in range(150)]
    docs += [(200, None), (201, ""), (202, " \x00\x1f!"), (None, prose(rng, 30, words)), (7, docs[7][1]), (7, docs[7][1])]
    target = [prose(rng, 30, words[:10]), None, "", "the of"]
    aim = llm.createDataFrame([(t, "b", 1) for t in target], "text string, bucket string, row int")
    settings = resample.Settings(percent=40, piece=64)
    got = [tuple(r) for r in resample.resample(docs_of(docs), aim, settings).collect()]
    assert sorted(got, key=str) == sorted(resampled(docs, target, percent=40), key=str)
    assert any(r[4] for r in got)


def test_resampling_of_long_texts_and_of_nothing(llm, docs_of):
    rng = random.Random(6)
    words = ["alpha", "béta", "gamma", "d" * 500]
    docs = [(1, prose(rng, 30000, words)), (2, "z" * 400000 + " " + prose(rng, 40, words))]
    aim = llm.createDataFrame([("alpha gamma",)], "text string")
    settings = resample.Settings(percent=50, piece=1000)
    got = [tuple(r) for r in resample.resample(docs_of(docs), aim, settings).collect()]
    assert sorted(got) == sorted(resampled(docs, ["alpha gamma"], percent=50))
    assert resample.resample(docs_of(docs).limit(0), aim).count() == 0
    assert resample.resample(docs_of(docs), aim.limit(0)).count() == 2


def test_ranks_over_several_ranges(llm):
    rows = llm.range(0, 1000, 1, 6).selectExpr("id AS row", "id % 7 AS score")
    got = resample.ranked(rows, [rows.score.desc(), rows.row.asc()], 900).collect()
    want = {r: n for n, r in enumerate(sorted(range(1000), key=lambda x: (-(x % 7), x)), 1)}
    assert all(r["rank"] == (want[r.row] if want[r.row] <= 900 else None) for r in got) and len(got) == 1000


# ---- winnowing


def contaminated(docs, items, span=10):
    wins = {}
    for name, text in items:
        words = WORD.findall(lowered(text))
        size = min(span, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            wins.setdefault(tuple(words[i : i + size]), set()).add("" if name is None else str(name))
    out = []
    for i, text in docs:
        words, hit, names = WORD.findall(lowered(text)), set(), set()
        for size in {len(w) for w in wins}:
            for at in range(len(words) - size + 1):
                found = wins.get(tuple(words[at : at + size]))
                if found:
                    hit.update(range(at, at + size))
                    names |= found
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((i, len(words), len(hit), len(names), digest, bool(hit)))
    return out


def leaky(rng, words, items, n):
    """Texts with whole items, parts of items, and items that overlap their neighbours."""
    for i in range(n):
        parts = [prose(rng, rng.randint(0, 30), words)]
        for _ in range(rng.randint(0, 3)):
            item = (rng.choice(items)[1] or "").split()
            lo = rng.randint(0, max(0, len(item) - 1))
            parts += [" ".join(item[lo : lo + rng.choice([4, 9, 10, 11, 40])]), prose(rng, rng.randint(0, 4), words)]
        yield i, " ".join(parts)


def test_winnowing_is_brute_force(llm, docs_of):
    rng = random.Random(11)
    words = [f"W{i}é" for i in range(8)] + ["the", "of", "9"]
    items = [(i, prose(rng, rng.choice([1, 3, 9, 10, 11, 25, 40]), words + [f"rare{j}" for j in range(200)])) for i in range(30)]
    items += [(40, None), (41, "!"), (None, items[3][1]), (3, "one more text of item three with just about enough words here"), (42, items[4][1])]
    docs = list(leaky(rng, words, items, 120)) + [(500, None), (501, ""), (None, items[5][1]), (502, items[5][1].upper()), (502, items[5][1].upper())]
    aim = llm.createDataFrame([(*i, 1, "x") for i in items], "item_id long, text string, row int, win string")
    settings = winnow.Settings(block=37, piece=50, cached_words=20)
    got = [tuple(r) for r in winnow.decontaminate(docs_of(docs), aim, settings).collect()]
    assert sorted(got, key=str) == sorted(contaminated(docs, items), key=str)
    assert 20 < sum(r[5] for r in got) < len(got)


def test_a_full_bitmap_loses_and_adds_nothing(llm, docs_of):
    """The join decides; a bitmap without any zero only lets more windows through."""
    rng = random.Random(12)
    words = [f"w{i}" for i in range(30)]
    items = [(i, prose(rng, 15, words)) for i in range(2000)]
    docs = list(leaky(rng, words, items, 40))
    aim = llm.createDataFrame(items, "item_id long, text string")
    settings = winnow.Settings(most_bits=1 << 10, bits_per_window=1)
    got = [tuple(r) for r in winnow.decontaminate(docs_of(docs), aim, settings).collect()]
    assert sorted(got, key=str) == sorted(contaminated(docs, items), key=str)


def test_every_shared_run_has_a_shared_fingerprint():
    rng = np.random.default_rng(2)
    for _ in range(50):
        run = rng.integers(0, 4, 10).astype(np.uint64)
        a = np.concatenate([rng.integers(0, 4, 30).astype(np.uint64), run, rng.integers(0, 4, 9).astype(np.uint64)])
        b = np.concatenate([rng.integers(0, 4, 3).astype(np.uint64), run])
        assert winnow.fingerprints(a, 10, 4)[30] == winnow.fingerprints(b, 10, 4)[3]


def test_winnowing_of_long_texts_and_of_nothing(llm, docs_of):
    rng = random.Random(13)
    words = [f"w{i}" for i in range(5000)]
    item = prose(rng, 60, words)
    docs = [(1, prose(rng, 40000, words) + " " + item + " " + prose(rng, 40000, words)), (2, "y" * 300000)]
    aim = llm.createDataFrame([(1, item)], "item_id long, text string")
    got = [tuple(r) for r in winnow.decontaminate(docs_of(docs), aim, winnow.Settings(block=1000, piece=1000)).collect()]
    assert sorted(got) == sorted(contaminated(docs, [(1, item)])) and max(got)[2] + min(got)[2] >= 60
    assert winnow.decontaminate(docs_of(docs).limit(0), aim).count() == 0
    assert not any(r.contaminated for r in winnow.decontaminate(docs_of(docs), aim.limit(0)).collect())
