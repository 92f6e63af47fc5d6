from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicstream.operators import batch_clustering as bc
from topicstream.operators import explore as ex
from topicstream.operators import word_space as ws
from topicstream.session import folders_in, shared_root


def tags(spark, rows):
    return spark.createDataFrame([(i, c, t) for i, (c, t) in enumerate(rows)], "o long, c long, t string")


def sequential_eval(rows):
    """The purity rule, one row after the other."""
    seen, within, cross, empty = {}, 0, 0, 0
    for c, t in rows:
        if not t:
            empty += 1
            continue
        cross += any(t in s for k, s in seen.items() if k != c)
        if c not in seen:
            seen[c] = [t]
            continue
        within += seen[c][0] != t
        if t not in seen[c]:
            seen[c].append(t)
    n = len(rows) - empty
    return within / n, cross / n**2, empty


def test_hashtag_eval_example(spark):
    got = ex.hashtag_eval(tags(spark, [(2, ""), (1, "top"), (1, "brexit")]), "c", "t", "o").head()
    assert tuple(got) == (0.5, 0.0, 1)


@pytest.mark.parametrize("seed, hot_rows", [(1, 10**6), (2, 3), (3, 0)])
def test_hashtag_eval_equals_the_sequential_rule(spark, seed, hot_rows):
    rng = np.random.default_rng(seed)
    rows = [(int(c), [None, "", "a", "b", "c", "d", "e"][t]) for c, t in zip(rng.integers(0, 5, 80), rng.integers(0, 7, 80))]
    got = ex.hashtag_eval(tags(spark, rows), "c", "t", "o", hot_rows).head()
    assert tuple(got) == pytest.approx(sequential_eval(rows))


def test_hashtag_eval_without_tags(spark):
    assert tuple(ex.hashtag_eval(tags(spark, [(1, None), (2, "")]), "c", "t", "o").head()) == (None, None, 2)


@pytest.mark.parametrize("hot_rows", [10**6, 2])
def test_duplicates_and_labels(spark, hot_rows):
    texts = ["Cats run", "cat  run", "cat run @you", "dog", "cat run", "bird", "dogs"]
    posts = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    groups = ex.duplicate_groups(posts, hot_rows)
    got = {r["id"]: (r["rep_id"], r["copies"]) for r in groups.collect()}
    assert got == {0: (0, 4), 1: (0, 4), 2: (0, 4), 4: (0, 4), 3: (3, 2), 6: (3, 2), 5: (5, 1)}
    assert {tuple(r) for r in ex.distinct_texts(groups).collect()} == {(0, 3), (3, 1), (5, 0)}
    labels = spark.createDataFrame([(0, 7), (5, 8), (6, 9)], "id long, label int")
    assert {tuple(r) for r in ex.propagate_labels(groups, labels, hot_rows).collect()} == {(0, 7), (1, 7), (2, 7), (4, 7), (5, 8)}
    updated = ex.update_labels(posts.withColumn("k", F.lit(1)), labels, "k").collect()
    assert {r["id"]: r["k"] for r in updated} == {0: 7, 1: 1, 2: 1, 3: 1, 4: 1, 5: 8, 6: 9}


def test_cohesion(spark):
    rows = [(1, 1, "red blue"), (2, 1, "red green"), (3, 1, "red red"), (4, 2, "alone"), (5, 3, "the"), (6, 3, "and")]
    posts = spark.createDataFrame(rows, "id long, cluster_id long, text string")
    got = {r["cluster_id"]: (r["score"], r["size"]) for r in ex.cluster_cohesion(posts).collect()}
    # words: red 3, blue 1, green 1; posts score 4/5, 4/5, 3/5
    assert got[1] == (pytest.approx((4 + 4 + 3) / 5 / 3), 3)
    assert got[3] == (0.0, 2) and 2 not in got


def test_mentions(spark):
    posts = spark.createDataFrame([("a", 5, ["b", "c"]), ("b", 7, ["b"]), ("b", 9, [])], "user_name string, followers_count long, mentions array<string>")
    counts = ex.mention_counts(posts)
    assert [tuple(r) for r in ex.top_mentions(counts, 1).collect()] == [("b", 2)]
    assert {tuple(r) for r in ex.author_reach(counts, posts).collect()} == {("b", 2, 9), ("c", 1, None)}


def brute_dbscan(vectors, eps, least):
    ids = sorted(vectors)
    near = {i: [j for j in ids if np.sqrt(((vectors[i] - vectors[j]) ** 2).sum()) <= eps] for i in ids}
    core = [i for i in ids if len(near[i]) >= least]
    label = {}
    for i in core:
        if i in label:
            continue
        todo = [i]
        while todo:
            p = todo.pop()
            if p in label:
                continue
            label[p] = i
            todo += [q for q in near[p] if q in core]
    out = {}
    for i in ids:
        around = [label[q] for q in near[i] if q in label]
        out[i] = label.get(i, min(around) if around else -1)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_dbscan_equals_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    base = rng.random((4, 12)) * (rng.random((4, 12)) < 0.5) + np.eye(12)[:4]
    vectors = {}
    for i in range(60):
        v = base[i % 4] + rng.random(12) * rng.choice([0, 0.1, 0.25]) * (rng.random(12) < 0.5)
        vectors[i] = np.round(v / np.linalg.norm(v), 9)
    vectors[60] = vectors[3].copy()
    vectors = {i: v / np.linalg.norm(v) for i, v in vectors.items()}
    rows = [(i, f"w{k}", float(x)) for i, v in vectors.items() for k, x in enumerate(v) if x > 0]
    got = {r["id"]: r["label"] for r in bc.dbscan(spark.createDataFrame(rows, "id long, word string, w double")).collect()}
    assert got == brute_dbscan(vectors, 0.3, 5)
    assert len(set(got.values())) > 1


def test_dbscan_folds_copies(spark):
    rows = [(i, "a", 1.0) for i in range(6)] + [(i, "b", 1.0) for i in range(6, 9)]
    got = {r["id"]: r["label"] for r in bc.dbscan(spark.createDataFrame(rows, "id long, word string, w double")).collect()}
    assert got == {i: 0 for i in range(6)} | {6: -1, 7: -1, 8: -1}


def test_candidates_hold_all_close_pairs_and_few_others(spark):
    """Texts that share one rare word and many frequent ones are no candidates; near copies are."""
    rng = np.random.default_rng(7)
    x = np.zeros((80, 140))
    for i in range(80):
        x[i, rng.choice(60, 25, replace=False)] = 1.0
        x[i, 60 + i // 2] = x[i, 100 + i // 4 * 2 % 40] = 0.6
    for i in range(0, 80, 10):
        x[i + 1] = x[i] + 0.05 * (rng.random(140) < 0.1)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = spark.createDataFrame([(i, j, float(x[i, j])) for i in range(80) for j in np.flatnonzero(x[i]).tolist()], "p long, code long, w double")
    df = rows.groupBy("code").agg(F.count("*").alias("df"))
    vectors = rows.join(df, "code").groupBy("p").agg(F.array_sort(F.collect_list(F.struct("df", "code", "w"))).alias("e"))
    cosine = 1 - 0.3 * 0.3 / 2
    keys = bc.lookup_words(vectors, cosine)
    under = keys.join(keys.select("code", F.col("p").alias("q")), "code").filter("p < q").select("p", "q").distinct().count()
    got = {tuple(r) for r in bc.candidate_pairs(keys, cosine).collect()}
    near = {(i, j) for i in range(80) for j in range(i + 1, 80) if ((x[i] - x[j]) ** 2).sum() <= 0.09}
    assert near and near <= got and 3 * len(got) < under
    assert {tuple(r) for r in bc.close_pairs(vectors, 0.3).collect()} == near


def space_of(spark, x):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, f"w{j}", float(v)) for i, row in enumerate(x) for j, v in enumerate(row) if v]
    return x, ws.word_space(spark.createDataFrame(rows, "id long, word string, w double"))


def plain_kmeans(x, k, rounds):
    import hashlib

    order = sorted(range(len(x)), key=lambda i: (hashlib.md5(str(i).encode()).hexdigest(), i))[:k]
    centers = x[order].copy()
    nearest = lambda: np.round(((x[:, None] - centers[None]) ** 2).sum(2), 9).argmin(1)
    for _ in range(rounds):
        own = nearest()
        for c in range(k):
            if (own == c).any():
                centers[c] = x[own == c].mean(0)
    return nearest()


def test_kmeans_and_silhouette_of_sparse_posts(spark):
    rng = np.random.default_rng(0)
    x = np.where(rng.random((60, 25)) < 0.25, rng.random((60, 25)), 0)
    x[:, 0] += 0.01
    x[20] = x[21] = x[22]
    x, space = space_of(spark, x)
    for k in (1, 4, 60, 80):
        got = {r["id"]: r["label"] for r in ws.kmeans_labels(space, k, 3).collect()}
        assert [got[i] for i in range(60)] == plain_kmeans(x, min(k, 60), 3).tolist()
    own = plain_kmeans(x, 4, 3)
    away = np.array([[((x[i] - x[own == c]) ** 2).sum() / max(1, (own == c).sum() - (own[i] == c)) for c in range(4)] for i in range(60)])
    want = []
    for i in range(60):
        a, b = away[i, own[i]], min(away[i, c] for c in range(4) if c != own[i] and (own == c).any())
        want.append((b - a) / max(a, b) if (own == own[i]).sum() > 1 else 0.0)
    assert abs(ws.silhouette(space, 4, 3) - np.mean(want)) < 1e-9


def test_kmeans_with_rare_words_in_a_table(spark):
    """A block of a few frequent words, the others as rows; as by one block over all words."""
    rng = np.random.default_rng(3)
    x = np.where(rng.random((50, 30)) < 0.2, rng.random((50, 30)), 0)
    x[:, 0] += 0.01
    x[10:20, 0], x[10:20, 29] = 0, 1  # posts without the most frequent word
    x, space = space_of(spark, x)
    for often in (1, 7):
        small = ws.WordSpace(space.posts, space.size, 10_000, often * 8 * 4)
        assert small.often(4) == often
        got = {r["id"]: r["label"] for r in ws.kmeans_labels(small, 4, 3).collect()}
        assert [got[i] for i in range(50)] == plain_kmeans(x, 4, 3).tolist()
    few = ws.WordSpace(space.posts, space.size, 800, 400)  # a block over all words is refused
    assert abs(ws.silhouette(few, 4, 2) - ws.silhouette(space, 4, 2)) < 1e-9


def test_latent_semantics_of_sparse_posts(spark):
    rng = np.random.default_rng(1)
    x, space = space_of(spark, np.where(rng.random((50, 40)) < 0.2, rng.random((50, 40)), 0) + np.eye(50, 40) + 0.02 * (np.arange(40) == 3))
    got = {r["id"]: r["reduced"] for r in ws.lsa_reduce(space, 2).collect()}
    want = x @ np.linalg.svd(x, full_matrices=False)[2][:2].T
    want /= np.linalg.norm(want, axis=1, keepdims=True)
    assert np.allclose(np.abs([got[i] for i in range(50)]), np.abs(want), atol=1e-6)


def test_latent_semantics_needs_few_rounds(monkeypatch):
    """Slowly falling singular values; and directions that settle at very different times, of which the early ones must not spoil the others."""
    passes = []
    monkeypatch.setattr(ws, "_gram_times", lambda space, block: passes.append(block.shape[1]) or space.x.T @ (space.x @ block))
    rng = np.random.default_rng(4)
    left, right = (np.linalg.qr(rng.standard_normal((size, 60)))[0] for size in (150, 80))
    rng = np.random.default_rng(1)
    thin = np.where(rng.random((50, 40)) < 0.2, rng.random((50, 40)), 0) + np.eye(50, 40) + 0.02 * (np.arange(40) == 3)
    for x in (left * 0.97 ** np.arange(60) @ right.T, thin):
        passes.clear()
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        got = ws.right_singular_vectors(SimpleNamespace(x=x, size=x.shape[1]), 2)
        assert np.allclose(np.abs(got), np.abs(np.linalg.svd(x)[2][:2].T), atol=1e-8)
        assert len(passes) <= 35 and max(passes) <= 4


def test_latent_semantics_of_few_words(spark):
    """Fewer words or independent posts than directions are asked for, and posts that are all equal."""
    for x in (np.ones((5, 1)), np.ones((4, 3)), np.eye(3), np.array([[1.0, 1, 0, 0], [0, 0, 1, 1], [1, 1, 0, 0]])):
        x, space = space_of(spark, x)
        basis = ws.right_singular_vectors(space, 2)
        assert np.allclose(basis.T @ basis, np.eye(basis.shape[1])) and basis.shape == (x.shape[1], min(2, x.shape[1]))
        assert len(ws.lsa_reduce(space, 2).collect()) == len(x)


def test_numbered_words_have_the_weights_of_the_rows(spark):
    """Lists of word numbers, with the frequent words broadcast or met by a join, hold what the rows (id, word, w) hold."""
    texts = [(n, f"common word{n % 7} word{n % 150} word{n % 150} once{n}") for n in range(300)]
    texts += [(5, "word5 word6"), (None, "word1 word2"), (None, "word1 word8"), (900, None), (901, ""), (902, "lonely")]
    posts = spark.createDataFrame(texts, "id long, text string")
    rows = {}
    for r in ex.tfidf_l2(posts, 2, 0.5, ()).collect():
        rows.setdefault(r["id"], []).append(r["w"])
    assert None in rows and not rows.keys() & {900, 901, 902}
    for often in (10**6, 5, 1):
        got = ex.tfidf_l2(posts, 2, 0.5, (), often, numbered=True).collect()
        assert len(got) == len(rows)
        for r in got:
            assert r["at"] == sorted(set(r["at"])) and np.allclose(sorted(r["w"]), sorted(rows[r["id"]]))
    numbers = ws.word_space(ex.tfidf_l2(posts, 2, 0.5, (), 5, numbered=True))
    used = [r["n"] for r in numbers.posts.select(F.explode("at").alias("at")).groupBy("at").agg(F.count("*").alias("n")).orderBy("at").collect()]
    assert len(used) == numbers.size and used == sorted(used, reverse=True)
    nothing = ws.word_space(ex.tfidf_l2(posts.filter("id > 899"), 2, 0.5, (), numbered=True))
    assert nothing.size == 0 and nothing.posts.count() == 0


def test_a_block_too_large_is_refused(spark):
    _, space = space_of(spark, np.eye(6))
    with pytest.raises(ValueError, match="min_df"):
        ws.WordSpace(space.posts, space.size, 100).share(np.zeros((6, 6)))


def test_word_counts_need_no_shuffle_and_merge_shared_ids(spark):
    texts = [(1, "red red green"), (2, "green blue"), (3, None), (None, "red"), (None, "red blue"), (4, ""), (2, "blue sky")]
    posts = spark.createDataFrame(texts, "id long, text string")
    expected = {(1, "red", 2), (1, "green", 1), (2, "green", 1), (2, "blue", 2), (2, "sky", 1), (None, "red", 2), (None, "blue", 1)}
    got = ex.word_rows(posts, ()).select("id", "word", "n").collect()
    assert {tuple(r) for r in got} == expected and len(got) == len(expected)
    alone = ex.word_rows(posts.filter("id in (1, 3, 4)"), ())
    assert {tuple(r) for r in alone.collect()} == {(1, "red", 2), (1, "green", 1)}
    assert "Exchange" not in alone._jdf.queryExecution().toString()


def test_weights_of_frequent_words_are_broadcast(spark):
    """The same weights with and without frequent words, whose counts meet no shuffled join."""
    posts = spark.createDataFrame([(n, f"common word{n % 7} word{n % 150}") for n in range(400)], "id long, text string")
    rows = {often: {(r["id"], r["word"]): r["w"] for r in ex.tfidf_l2(posts, 2, 1.0, (), often).collect()} for often in (10**6, 1)}
    assert rows[10**6].keys() == rows[1].keys() and rows[1]
    assert all(abs(w - rows[1][key]) < 1e-12 for key, w in rows[10**6].items())


def test_kmeans_runs_share_their_passes_and_leave_no_tables(spark, monkeypatch):
    """Runs with several numbers of clusters, with rare words in many segments, give what each gives alone, in as many passes as one of them needs."""
    rng = np.random.default_rng(7)
    x = np.where(rng.random((60, 90)) < 0.2, rng.random((60, 90)), 0) + 0.01 * (np.arange(90) == 0)
    _, space = space_of(spark, x)
    monkeypatch.setattr(ws, "TAIL_WORDS", 8)
    monkeypatch.setattr(ws, "FETCHED", 200)
    small, passes, means = ws.WordSpace(space.posts, space.size, often_bytes=900), [], ws._means
    monkeypatch.setattr(ws, "_means", lambda *args, **kw: passes.append(means(*args, **kw)) or passes[-1])
    before = folders_in(spark, f"{shared_root(spark)}/topicstream")
    got = ws.silhouettes(small, [2, 5, 9], 4)
    assert len(passes) <= 5 and len(passes[0][0].tail) > 1
    assert np.allclose(got, [ws.silhouette(space, k, 4) for k in (2, 5, 9)], atol=1e-9)
    labels = {r["id"]: r["label"] for r in ws.kmeans_labels(small, 9, 4).collect()}
    assert labels == {r["id"]: r["label"] for r in ws.kmeans_labels(space, 9, 4).collect()}
    assert folders_in(spark, f"{shared_root(spark)}/topicstream") == before


def test_numbered_words_leave_the_vectors_and_the_words(spark):
    posts = spark.createDataFrame([(n, f"word{n % 5} word{n % 3} more{n % 4}") for n in range(40)], "id long, text string")
    before = set(folders_in(spark, f"{shared_root(spark)}/topicstream"))
    vectors, words = ex.word_vectors(posts, 2, 0.9, (), 3)
    left = sorted(name.rsplit("-", 1)[0] for name in set(folders_in(spark, f"{shared_root(spark)}/topicstream")) - before)
    assert left == ["vocabulary", "word-vectors"]
    labels = posts.select("id", (F.col("id") % 3).alias("cluster_id"))
    rows = [ex.top_terms(t, labels, 3, 4, w) for t, w in ((vectors, words), (ex.tfidf_l2(posts, 2, 0.9, ()), None))]
    listed, plain = (sorted((r["cluster_id"], r["rank"], r["word"], r["size"], round(r["weight"], 9)) for r in t.collect()) for t in rows)
    assert listed == plain and listed


def test_dbscan_leaves_points_members_and_pairs(spark):
    rows = [(n, f"w{n % 4}", 1.0) for n in range(30)] + [(50, "x", 0.6), (50, "y", 0.8)]
    before = set(folders_in(spark, f"{shared_root(spark)}/topicstream"))
    got = {r["id"]: r["label"] for r in bc.dbscan(spark.createDataFrame(rows, "id long, word string, w double"), 0.3, 5).collect()}
    assert got == {**{n: n % 4 for n in range(30)}, 50: -1}
    left = sorted(name.rsplit("-", 1)[0] for name in set(folders_in(spark, f"{shared_root(spark)}/topicstream")) - before)
    assert left == ["close-pairs", "members", "points"]
