"""Language ID, quality classifier and language model on small fixtures."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicstream.llm import bloom_lm, langid, quality
from topicstream.llm.common import id_remainder

WORDS = {"en": "the of and water house under north".split(), "de": "der die und wasser haus unter nordén".split()}


def sentences(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = ("en", "de")[i % 2]
        rows.append((i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(5, 40))), lang))
    return rows


def test_id_remainder_is_crc32_of_the_id_as_text(llm):
    rows = llm.createDataFrame([(5,), (123456,), (None,)], "doc_id long").select(id_remainder("doc_id", 4).alias("r")).collect()
    assert [r.r for r in rows] == [zlib.crc32(b"5") % 4, zlib.crc32(b"123456") % 4, -1]


def test_language_of_held_out_texts_and_of_odd_ones(docs_of):
    rows = sentences(200)
    odd = [(900, None, "en"), (901, "", None), (902, "12 34 !!", "de"), (None, "der die und", None), (900, None, "en")]
    docs = docs_of(rows + odd)
    settings = langid.Settings(epochs=40)
    net = langid.fit(docs, id_remainder("doc_id", 4) != 2, settings)
    got = langid.predict(docs, net, ["doc_id"], settings).collect()
    assert len(got) == len(rows) + len(odd)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].lang_pred == lang for i, _, lang in rows)
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (900, 901, 902))
    assert by_id[None].lang_pred == "de"


def test_numerals_are_no_letters_and_odd_ids_are_drawn(docs_of):
    rows = [(None, t, lang) for _, t, lang in sentences(400)] + [(8, t, lang) for _, t, lang in sentences(400, 2)]
    rows += [(1, "½ ² ①② ⅣⅤ 12", "en"), (2, "ª der", None)]
    docs = docs_of(rows)
    small = langid.Settings(epochs=30, windows_per_language=100)
    net = langid.fit(docs, F.lit(True), small)
    got = langid.predict(docs, net, ["doc_id"], small).collect()
    assert {r.lang_pred for r in got if r.doc_id == 1} == {"und"} and {r.lang_pred for r in got if r.doc_id == 2} != {"und"}
    assert np.mean([r.lang_pred == row[2] for r, row in zip(got, rows[:800])]) > 0.97
    taken = []
    langid_train = langid.train
    try:
        langid.train = lambda windows, languages, settings: taken.append(languages) or langid_train(windows, languages, settings)
        langid.fit(docs_of([(8, "the of and", "en")] * 3000), F.lit(True), small)
        langid.fit(docs_of([(None, "the of and", "en")] * 3000), F.lit(True), small)
    finally:
        langid.train = langid_train
    assert all(50 < len(t) < 160 for t in taken)


def test_every_window_of_a_long_text_counts(docs_of):
    rows = sentences(100)
    long_text = " ".join(["the of and"] * 20) + " " + " ".join(["der die und"] * 400)
    docs = docs_of([*rows, (500, long_text, None)])
    net = langid.fit(docs, F.lit(True), langid.Settings(epochs=40))
    assert langid.predict(docs, net, ["doc_id"]).filter("doc_id = 500").head().lang_pred == "de"


def test_language_without_labels_or_rows(docs_of):
    docs = docs_of([(1, "abc", None)])
    net = langid.fit(docs, F.lit(True))
    assert net is None and langid.predict(docs, net, ["doc_id"]).head().lang_pred == "und"
    assert langid.predict(docs.limit(0), net, ["doc_id"]).count() == 0


def test_gradients_of_the_network():
    rng = np.random.default_rng(0)
    settings = langid.Settings(window=12, embedding=2, filters=((2, 3), (3, 2)))
    windows = rng.integers(97, 105, (6, 12)).astype(np.uint8)
    y, weight = np.array([0, 1, 2, 0, 1, 2]), np.ones(6)
    mask = langid.kernel_mask(settings)
    params = [rng.standard_normal(s) for s in ((256, 2), mask.shape, (5,), (5, 3), (3,))]
    net = langid.Network(["a", "b", "c"], params[0], params[1] * mask, *params[2:])
    loss = lambda: -langid.window_scores(net, windows)[np.arange(6), y].mean()
    got = langid.backward(net, windows, y, weight)
    for name in ("embedding", "kernel", "kernel_bias", "head", "head_bias"):
        value = getattr(net, name)
        for at in [tuple(rng.integers(0, s) for s in value.shape) for _ in range(5)] + ([(98, 1)] if name == "embedding" else []):
            before = value[at]
            value[at] = before + 1e-5
            up = loss()
            value[at] = before - 1e-5
            slope = (up - loss()) / 2e-5
            value[at] = before
            assert slope == pytest.approx(got[name][at], abs=1e-5)


def junk(i):
    return (f"text {i} of plain words and more of them here. " * (3 + i % 5), 1) if i % 3 else (f"BUY!! N{i}!! $$$ ### NOW!! " * (3 + i % 4), 0)


def test_quality_of_held_out_texts(llm, docs_of):
    docs = docs_of([(i, junk(i)[0]) for i in range(240)] + [(None, "a b"), (900, None), (901, "")])
    labels = llm.createDataFrame([(i, junk(i)[1]) for i in range(240)] + [(None, 1), (900, None)], "doc_id long, label int")
    stats = quality.text_statistics(docs, ["doc_id"])
    trainable = id_remainder("doc_id", 3) != 1
    got = {r.doc_id: r for r in quality.predict(stats, quality.fit(stats, labels, trainable)).collect()}
    assert len(got) == 243 and all(0 <= r.score <= 1 for r in got.values())
    assert all(got[i].predicted == junk(i)[1] for i in range(240))
    one = quality.fit(stats, labels.filter("label = 1"), trainable)
    assert {r.predicted for r in quality.predict(stats, one).collect()} == {1}
    assert quality.fit(stats, labels.limit(0), trainable) is None
    assert quality.predict(stats.limit(0), None).count() == 0


def test_normal_equations_are_the_direct_ones(llm):
    rng = np.random.default_rng(2)
    x, y, fold = rng.random((50, quality.WIDTH)), rng.integers(0, 2, 50), rng.integers(0, 4, 50)
    rows = [(list(map(float, a)), float(b), int(c)) for a, b, c in zip(x, y, fold, strict=True)]
    df = llm.createDataFrame(rows, "stats array<double>, label double, fold int").repartition(7)
    settings = quality.Settings(features=10, merge_width=2)
    mean, scale = x.mean(0), x.std(0)
    got = quality.normal_equations(df, mean, scale, settings)
    z = quality.fourier(x, mean, scale, settings)
    for k in range(4):
        own = z[fold == k]
        assert np.allclose(got[k], own.T @ np.hstack([own, y[fold == k][:, None]]))


def test_isotonic_pools():
    x, y = quality.isotonic(np.arange(5.0), np.array([0, 1, 0, 1, 1.0]), np.ones(5))
    assert list(y) == [0, 0.5, 1.0] and list(x) == [0, 1.5, 3.5]


def test_language_model_against_plain_counts(docs_of):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choices(vocabulary, weights=range(1, 61), k=rng.randint(0, 80)))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "Never SEEN words"), (502, "Never SEEN words"), (None, "w1 w2")]
    docs = docs_of(rows).select("doc_id", "text", (id_remainder("doc_id", 5) == 1).alias("held_out"), "score")
    settings = bloom_lm.Settings(base=1.000001, run_tokens=500, block_bytes=3000)
    model = bloom_lm.fit(docs, ~F.col("held_out"), bloom_lm.Settings(run_tokens=500, block_bytes=3000))
    got = bloom_lm.score(docs.drop("score"), model, ["doc_id", "held_out"], bloom_lm.Settings(run_tokens=500, block_bytes=3000)).collect()
    assert len(got) == len(rows)
    count, pairs = Counter(), Counter()
    tokens = [((t or "").lower().split() + [None]) for _, t in rows]
    for (i, _), words in zip(rows, tokens, strict=True):
        if i is None or zlib.crc32(str(i).encode()) % 5 != 1:
            count.update(words), pairs.update(zip(["^", *words], words, strict=False))
    n, v = sum(count.values()), len(count)
    p = lambda w: (count[w] + 0.5) / (n + 0.5 * (v + 1))
    plain = sorted((sum(math.log10(p(w)) for w in words), sum(count[w] > 0 for w in words), len(words)) for words in tokens)
    for (base, known, size), r in zip(plain, sorted(got, key=lambda r: (r.base_score, r.n_known, r.n_tokens)), strict=True):
        assert r.base_score == pytest.approx(base) and (r.n_known, r.n_tokens, r.train_tokens) == (known, size, n)
    assert all(r.score <= 0 for r in got) and settings.base > 1


def test_filter_levels_and_their_counts():
    settings = bloom_lm.Settings(segments=2)
    counts = np.array([1, 1, 2, 3, 5, 40, 1000])
    keys = np.arange(7, dtype=np.uint64) * np.uint64(7919)
    bits = 1 << 14
    bloom = np.concatenate([bloom_lm.enter(keys, counts, bits, settings), np.zeros(bits // 8, np.uint8)])
    level = bloom_lm.levels(keys, bloom, settings)
    estimate = bloom_lm.expected_counts(level, settings.base)
    assert (np.abs(estimate / counts - 1) < 0.3).all()
    other = bloom_lm.levels(keys + (np.uint64(1) << np.uint64(32)), bloom, settings)
    assert not other.any()


def test_language_model_of_nothing(docs_of):
    docs = docs_of([(1, "a b"), (2, None)]).select("doc_id", "text")
    model = bloom_lm.fit(docs, F.lit(False))
    got = bloom_lm.score(docs, model, ["doc_id"]).collect()
    assert [(r.train_tokens, r.base_score, r.score) for r in got] == [(0, 0.0, 0.0)] * 2
    assert bloom_lm.score(docs.limit(0), model, ["doc_id"]).count() == 0


def test_filter_grows_with_its_entries_and_probes_end(docs_of):
    rng = random.Random(6)
    rows = [(i, " ".join(f"w{rng.randrange(4000)}" for _ in range(400))) for i in range(120)]
    docs = docs_of(rows).select("doc_id", "text")
    settings = bloom_lm.Settings(segments=4, least_bytes=64, block_bytes=30_000)
    model = bloom_lm.fit(docs, F.lit(True), settings)
    assert model.segments > settings.segments
    rows = model.tables.filter(F.col("kind") == bloom_lm.PAIRS).collect()
    assert len(rows) == model.segments
    # at most half of the bits of any segment are set, whatever the volume
    assert max(np.unpackbits(np.frombuffer(r["keys"], np.uint8)).mean() for r in rows) < 0.5
    assert sum(len(r["keys"]) * 8 for r in rows) >= settings.entry_bits * 40_000
    # held-out pairs are hardly ever taken for known ones: their score is that of the smoothed unigram
    words = [f"w{rng.randrange(4000)}" for _ in range(400)]
    got = bloom_lm.score(docs_of([(1, " ".join(words))]).select("doc_id", "text"), model, ["doc_id"], settings).head()
    count, pairs = Counter(), Counter()
    for r in docs.collect():
        found = [*r.text.split(), None]
        count.update(found), pairs.update(zip(["^", *found], found, strict=False))
    count["^"], n, v = len(docs.collect()), sum(count.values()), len(count)
    p = lambda w: (count[w] + 0.5) / (n + 0.5 * (v + 1))
    want = sum(math.log10((pairs[a, b] + 8 * p(b)) / (count[a] + 8)) for a, b in zip(["^", *words], [*words, None], strict=True))
    assert got.score == pytest.approx(want, rel=0.02)
    full = np.full(1 << 8, 255, np.uint8)
    assert list(bloom_lm.levels(np.arange(3, dtype=np.uint64), full, bloom_lm.Settings(segments=1), 7)) == [7] * 3


def plain_language(net, text, settings):
    """One text through the network, byte by byte and filter by filter."""
    data = "".join(c.lower() if c.isascii() else c for c in text).encode()
    depth, widest = net.embedding.shape[1], net.kernel.shape[0] // net.embedding.shape[1]
    total, size = np.zeros(len(net.languages)), settings.window
    for lo in range(0, len(data), size):
        window = data[lo : lo + size]
        padded = window + b" " * (size - len(window))
        hidden = []
        for f in range(net.kernel.shape[1]):
            best = max(
                sum(float(net.embedding[padded[p + w]] @ net.kernel[w * depth : (w + 1) * depth, f]) for w in range(widest))
                for p in range(size - widest + 1)
            )
            hidden.append(max(0.0, best + float(net.kernel_bias[f])))
        out = np.array(hidden) @ net.head + net.head_bias
        out -= out.max()
        total += len(window) * (out - math.log(np.exp(out).sum()))
    mean = np.exp(total / len(data) - (total / len(data)).max())
    mean /= mean.sum()
    return net.languages[int(mean.argmax())], float(mean.max())


def test_prediction_is_the_network_window_by_window(docs_of):
    settings = langid.Settings(epochs=10, window=32)
    net = langid.fit(docs_of(sentences(60)), F.lit(True), settings)
    texts = ["The", "der NORDÉN und the house " * 4, "x" * 33, "the of and water" * 2, "dïé wasser"]
    got = langid.predict(docs_of(list(enumerate(texts))), net, ["doc_id"], settings).collect()
    for row in got:
        label, score = plain_language(net, texts[row.doc_id], settings)
        assert row.lang_pred == label and abs(row.score - score) < 1e-4


def test_quality_is_ridge_and_isotonic_on_all_rows(llm, docs_of):
    """Folds, solutions, calibration and prediction, each restated on whole matrices."""
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["good", "text.", "CLICK", "here!!!", "x1", "##"][: 3 + 3 * (i % 2)]) for _ in range(rng.randint(1, 30))) for i in range(160)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "good text"), (3, texts[3]), (500, "")]
    labels = llm.createDataFrame([(i, int(i % 2 == 0 or i % 11 == 0)) for i in range(120)] + [(4, 0), (None, 1)], "doc_id long, label int")
    settings = quality.Settings(features=12, bins=50)
    stats = quality.text_statistics(docs_of(rows), ["doc_id"]).cache()
    model = quality.fit(stats, labels, F.col("doc_id") % 5 != 0, settings)
    got = {r.doc_id: (r.score, r.predicted) for r in quality.predict(stats, model, settings).collect()}

    fold = F.pmod(F.xxhash64(F.lit(settings.seed), "doc_id"), F.lit(settings.folds)).alias("fold")
    known = {i: int(i % 2 == 0 or i % 11 == 0) for i in range(120)}
    data = [(r.doc_id, np.array(r.stats), r.fold) for r in stats.select("doc_id", "stats", fold).collect()]
    train = [(s, known[i], f) for i, s, f in data if i is not None and i % 5 and i in known]
    x, y, folds = np.array([t[0] for t in train]), np.array([float(t[1]) for t in train]), np.array([t[2] for t in train])
    mean, scale = x.mean(0), np.where(x.std(0) < 1e-9, 1.0, x.std(0))
    z = quality.fourier(x, mean, scale, settings)

    def ridge(rows_used):
        a, n = z[rows_used], rows_used.sum()
        return np.linalg.solve(a.T @ a + settings.ridge * n * np.eye(a.shape[1]), a.T @ y[rows_used])

    raw = np.array([z[i] @ ridge(folds != folds[i]) for i in range(len(y))])
    place = (np.clip((raw + 0.5) / 2, 0, 1) * settings.bins).astype(int)
    bins = [(raw[place == b].mean(), y[place == b].mean(), (place == b).sum()) for b in np.unique(place)]
    values, weights = np.array([b[1] for b in bins]), np.array([b[2] for b in bins])
    mean_of = lambda j, k: (values[j : k + 1] * weights[j : k + 1]).sum() / weights[j : k + 1].sum()
    level = [max(min(mean_of(j, k) for k in range(i, len(bins))) for j in range(i + 1)) for i in range(len(bins))]
    centers, heights = [], []
    for v in sorted(set(np.round(level, 12))):  # bins of one height are one pool
        pool = np.flatnonzero(np.abs(np.array(level) - v) < 1e-9)
        centers.append((np.array([bins[i][0] for i in pool]) * weights[pool]).sum() / weights[pool].sum())
        heights.append(v)
    final = ridge(np.ones(len(y), bool))
    for i, s, _ in data:
        want = np.clip(np.interp(quality.fourier(s[None], mean, scale, settings) @ final, centers, heights), 0, 1)[0]
        assert abs(got[i][0] - want) < 1e-6 and got[i][1] == int(got[i][0] >= 0.5)
