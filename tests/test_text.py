import math

import pytest
from pyspark.sql import functions as F

from topicstream.functions import text as tx
from topicstream.functions.stemmer import english_stem, stem_table, stem_words
from topicstream.functions.vectors import round2
from topicstream.operators import features as fe


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "text string").select(expression(F.col("text"))).head()[0]


def plain_hash(word: str) -> int:
    units = word.encode("utf-16-be")
    h = 0
    for i in range(0, len(units), 2):
        h = (31 * h + units[i] * 256 + units[i + 1]) % 2**32
    return h - 2**32 if h >= 2**31 else h


def test_sanitizer_keeps_and_drops(spark):
    text = "don't @bob https://t.co/x cut… rt ☃ \U0001f600 \U0001f914 #news"
    words = one(spark, text, lambda c: tx.sanitize_tokens(tx.tokenize(c)))
    assert words == ["dont", "\U0001f914", "news"]


@pytest.mark.parametrize(
    "word, stem",
    [("parties", "party"), ("zombies", "zomby"), ("aies", "aies"), ("eies", "eies"), ("horses", "horse"), ("shoes", "shoes"),
     ("trees", "trees"), ("cats", "cat"), ("bus", "bus"), ("glass", "glass"), ("s", "s"), ("", ""), ("dogs.", "dogs.")],
)
def test_stemmer(spark, word, stem):
    assert one(spark, word, tx.stem_word) == stem


def test_all_steps_in_one_pass(spark):
    text = "The  cats, and\tDOGS ran! to http://x.y parties @you 'buses' classes running."
    steps = lambda c: tx.remove_stopwords(tx.sanitize_tokens(tx.stem_tokens(tx.tokenize(c))))
    assert one(spark, text, tx.post_tokens) == one(spark, text, steps)
    assert one(spark, text, tx.post_tokens) == ["cats", "dog", "ran", "party", "buses", "classe", "running"]


def test_hash_buckets(spark):
    words = ["hello", "breaking", "news", "", "é", "\U0001f914x", "a" * 300, "Ünïcödé…"]
    rows = spark.createDataFrame([(w,) for w in words], "w string")
    got = {r[0]: (r[1], r[2]) for r in rows.select("w", tx.string_hash(F.col("w")), tx.hash_bucket(F.col("w"), 100)).collect()}
    for word in words:
        assert got[word] == (plain_hash(word), plain_hash(word) % 100)
    assert [got[w][1] for w in ("hello", "breaking", "news")] == [22, 63, 75]
    assert tx.java_hashes(words).tolist() == [plain_hash(w) for w in words]


def test_bucket_counts_and_idf(spark):
    rows = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["a"]), (3, [])], "id long, tokens array<string>")
    counted = fe.term_vectors(rows, 100)
    weighted = {r["id"]: r for r in fe.weight_vectors(counted).collect()}
    assert weighted[1]["tfidf"][97] == pytest.approx(2 * math.log(4 / 3))
    assert weighted[1]["tfidf"][98] == pytest.approx(math.log(4 / 2))
    assert weighted[3]["vec_sum"] == 0 and len(weighted[3]["tfidf"]) == 100
    murmur = fe.term_vectors(rows, 100, method="murmur3").select("tf").collect()
    assert [sum(r["tf"].toArray()) for r in murmur] == [3, 1, 0]


def test_collision_report_lists_words_that_share_a_bucket(spark):
    posts = spark.createDataFrame([(1, "alpha bravo"), (2, "bravo charlie delta")], "id long, text string")
    rows = fe.collision_report(posts, dims=2).collect()
    words = ["alpha", "bravo", "charlie", "delta"]
    expected = {b: sorted(w for w in words if plain_hash(w) % 2 == b) for b in (0, 1)}
    assert [(r["bucket"], r["word"]) for r in rows] == [(b, w) for b in (0, 1) for w in expected[b] if len(expected[b]) > 1]


def test_clean_text_and_stem_text(spark):
    assert one(spark, "see https://t.co/a @you now htt…", tx.clean_text) == "see   now"
    assert one(spark, " Cats  and\nPonies ", tx.stem_text) == "cat and pony"


def test_round2(spark):
    values = [1.005, 0.125, -0.125, math.inf, math.nan, None]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    assert [r[0] for r in rows.orderBy("i").select(round2(F.col("x"))).collect()] == [1.01, 0.13, -0.13, 0.0, 0.0, 0.0]


PUBLISHED = """consign consign consigned consign consigning consign consignment consign consist consist consisted consist consistency consist
consistent consist consistently consist consisting consist consists consist consolation consol consolations consol consolatory consolatori console consol
consoled consol consoles consol consolidate consolid consolidated consolid consolidating consolid consoling consol consonant conson consort consort
knack knack knackeries knackeri knavish knavish knead knead kneading knead knee knee kneel kneel kneeling kneel knew knew knife knife knight knight
knightly knight knights knight knit knit knitted knit knitting knit knives knive knob knob knock knock knocking knock knots knot"""


def test_english_stems_of_the_published_sample():
    words = PUBLISHED.split()
    assert {w: english_stem(w) for w in words[::2]} == dict(zip(words[::2], words[1::2]))


@pytest.mark.parametrize(
    "word, stem",
    [("ties", "tie"), ("cries", "cri"), ("gas", "gas"), ("this", "this"), ("gaps", "gap"), ("kiwis", "kiwi"), ("luxuriated", "luxuri"), ("hopping", "hop"),
     ("hoped", "hope"), ("falling", "fall"), ("bed", "bed"), ("shed", "shed"), ("by", "by"), ("say", "say"), ("cry", "cri"), ("generically", "generic"),
     ("generate", "generat"), ("communism", "communism"), ("proceeding", "proceed"), ("skies", "sky"), ("news", "news"), ("relational", "relat"),
     ("analogi", "analog"), ("bowl's", "bowl"), ("youth", "youth"), ("boyish", "boyish"), ("", ""), ("ß", "ß"), ("nth", "nth")],
)
def test_english_rules(word, stem):
    assert english_stem(word) == stem


def test_stems_are_joined_back(spark):
    rows = spark.createDataFrame([(1, "cats"), (2, "cats"), (3, "running"), (4, None)], "id long, word string")
    got = {r["id"]: r["stem"] for r in stem_words(rows).collect()}
    assert got == {1: "cat", 2: "cat", 3: "run", 4: None} and stem_table(rows).count() == 2
