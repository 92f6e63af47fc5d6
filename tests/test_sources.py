import json
import random

from pyspark.sql import functions as F

from topicstream.operators.skew import join_per_key, with_position
from topicstream.plans import inputs as inp
from topicstream.session import new_run_dir
from topicstream.sources import posts as src
from topicstream.sources import raw, terms


def parsed(spark, *records):
    lines = [(r if isinstance(r, str) else json.dumps(r),) for r in records]
    return raw.parse_raw(spark.createDataFrame(lines, "raw string"))


def post(n, text, **more):
    return {"id": n, "text": text, "lang": "en", "timestamp_ms": str(n * 1000), **more}


def test_control_records(spark):
    rows = parsed(spark, {"delete": None, "id": 1}, {"id": 2, "text": "limit"}, {"limit": {"track": 1}},
                  {"id": 3, "x": {"delete": 1}}, "not json")
    kept = raw.drop_control_records(rows).select(F.try_variant_get("record", "$.id", "bigint")).collect()
    assert sorted(r[0] for r in kept) == [2, 3]
    assert [r["raw"] for r in raw.quarantined(rows).collect()] == ["not json"]


def test_quotes_at_any_depth(spark):
    user = {"id": 9, "screen_name": "inner", "followers_count": 5}
    inner = post(4, "d", user=user, entities={"hashtags": [{"text": "x"}, {"text": "y"}], "urls": []})
    chain = post(1, "a", quoted_status=post(2, "b", quoted_status=post(3, "c", quoted_status=inner)))
    german = post(5, "e", quoted_status=post(6, "f") | {"lang": "de"})
    deep_german = post(7, "g", quoted_status=post(8, "h", quoted_status=post(9, "i") | {"lang": "de"}))
    plain = post(745000000000000123, "j", entities={"hashtags": []})
    rows = {r["id"]: r for r in raw.collect_posts(parsed(spark, chain, german, deep_german, plain)).collect()}
    assert sorted(rows) == [1, 745000000000000123]
    got = rows[1]
    assert got["text"] == "a @QUOTED: b @QUOTED: c @QUOTED: d" and got["timestamp"] == "1000"
    assert (got["user_name"], got["followers_count"], got["hashtags"], got["urls"]) == ("inner", 5, "x,y", None)
    assert rows[745000000000000123]["hashtags"] is None


def test_thirty_quotes_and_keys_in_texts(spark):
    chain = post(99, 'the "quoted_status": {{{ of it')
    for n in range(30):
        chain = post(n, f"t{n}", quoted_status=chain)
    none = post(500, "x", quoted_status=None)
    rows = {r["id"]: r for r in raw.flatten_quotes(parsed(spark, chain, none)).collect()}
    assert rows[29]["level"] == 30 and rows[500]["level"] == 0 and rows[500]["text"] == "x"
    assert rows[29]["text"].split(raw.QUOTE_MARK) == [f"t{n}" for n in range(29, -1, -1)] + ['the "quoted_status": {{{ of it']


def test_mentions_are_those_of_the_record_itself(spark):
    said = lambda *names: {"user_mentions": [{"screen_name": n} for n in names]}
    rows = parsed(spark, post(1, "a", entities=said("outer"), quoted_status=post(2, "b", entities=said("inner")) | {"lang": "de"}), post(3, "c"))
    assert {r["record_id"]: r["mentions"] for r in raw.own_entities(rows).select(F.try_variant_get("record", "$.id", "bigint").alias("record_id"), "mentions").collect()} == {1: ["outer"], 3: None}


def test_read_posts(spark):
    path = new_run_dir(spark, "t")
    lines = ['{"id": 745000000000000123, "text": "a", "urls": "u,v", "timestamp": "1500"}', '{"id": 2, "text": "b", "urls": null}']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    got = {r["id"]: r for r in src.read_posts(spark, path).collect()}
    assert got[745000000000000123]["urls"] == ["u", "v"] and got[2]["urls"] == [] and got[2]["ts"] is None


def test_first_row_of_an_id_is_kept(spark):
    new = spark.createDataFrame([(1, "late", 5), (1, "first", 2), (2, "x", 1), (3, "y", 3)], "id long, text string, seq long")
    stored = spark.createDataFrame([(3,)], "id long")
    assert {(r["id"], r["text"]) for r in raw.upsert_posts(new, "seq", stored).collect()} == {(1, "first"), (2, "x")}
    tied = spark.createDataFrame([(1, "b", 5), (1, "a", 5), (1, "a", 5)], "id long, text string, seq long")
    assert [(r["id"], r["text"]) for r in raw.upsert_posts(tied, "seq").collect()] == [(1, "a")]


def test_terms(spark):
    line = lambda *v: spark.createDataFrame([(x,) for x in v], "value string")
    got = terms.term_union(line("site com", "other org "), line("breaking", "site com"), line("Some Paper - @Handle"))
    assert sorted(r["term"] for r in got.collect()) == ["Handle", "breaking", "other org", "site com"]
    posts = spark.createDataFrame([(1, "com at Site"), (2, "site only"), (3, "BREAKING now"), (4, "")], "id long, text string")
    of = lambda *t: spark.createDataFrame([(x,) for x in t], "term string")
    assert [r["id"] for r in terms.track_filter(posts, of("site com", "breaking", "  ", "COM  site")).orderBy("id").collect()] == [1, 3]
    assert terms.track_filter(posts, of()).count() == 0


def test_track_filter_with_many_phrases_is_brute_force(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    phrases = [" ".join(rng.choice(words + ["absent"]) for _ in range(rng.randint(1, 4))) for _ in range(2000)]
    phrases = [p for p in phrases if len(set(p.split())) > 2] + ["w1 absent", "w7"]
    rows = [(i % 30, " ".join(rng.choice(words).upper() for _ in range(rng.randint(0, 9)))) for i in range(200)] + [(5, None), (6, "w7"), (6, "w7")]
    posts = spark.createDataFrame(rows, "id long, text string")
    got = terms.track_filter(posts, spark.createDataFrame([(p,) for p in phrases], "term string")).collect()
    want = [r for r in rows if r[1] is not None and any(set(p.split()) <= set(r[1].lower().split()) for p in phrases)]
    assert sorted((r["id"], r["text"]) for r in got) == sorted(want) and 0 < len(want) < len(rows)


def test_positions_over_many_ranges(spark):
    ids = [(i * 37) % 1009 + (10_000 if i % 3 == 0 else 0) for i in range(700)]
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(5)
    for size in (50, 10_000):
        got = {r["id"]: r["position"] for r in with_position(df, "id", size).collect()}
        assert got == {v: n for n, v in enumerate(sorted(ids))}
    sliced = {r["id"]: r["batch_index"] for r in src.slice_batches(df, 100, 3, rows_per_range=64).collect()}
    assert sliced == {v: n // 100 for n, v in enumerate(sorted(ids)[:300])}
    assert with_position(df.filter("id < 0"), "id").collect() == []


def test_snapshot_is_keyed_by_its_source(spark):
    root = new_run_dir(spark, "t")
    first = src.prepared_snapshot(spark.range(10), root, "one", 2, 3)
    again = src.prepared_snapshot(spark.range(100, 110), root, "one", 2, 3)
    other = src.prepared_snapshot(spark.range(100, 110), root, "two", 2, 3)
    assert sorted(r["id"] for r in first.collect()) == sorted(r["id"] for r in again.collect()) == list(range(6))
    assert sorted(r["id"] for r in other.collect()) == list(range(100, 106))
    turned = src.prepared_snapshot(spark.range(10).withColumn("back", -F.col("id")), root, "one", 2, 3, "back")
    assert sorted(r["id"] for r in turned.collect()) == list(range(4, 10))


def test_snapshot_of_a_failed_write(spark, tmp_path):
    first = src.prepared_snapshot(spark.range(10), str(tmp_path), "one", 2, 3)
    (folder,) = tmp_path.iterdir()
    (folder / "_SUCCESS").rename(folder / "_lost")
    again = src.prepared_snapshot(spark.range(100, 110), str(tmp_path), "one", 2, 3)
    assert sorted(r["id"] for r in again.collect()) == list(range(100, 106)) and first.columns == again.columns


def test_look_up_with_hot_keys(spark):
    keys = ["hot"] * 500 + ["warm"] * 20 + [f"k{i}" for i in range(30)] + ["unknown"] * 5
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, key string")
    counts = rows.filter("key <> 'unknown'").groupBy("key").count().withColumn("value", F.upper("key"))
    for limit in (0, 10, 1000):
        got = {r["id"]: r["value"] for r in join_per_key(rows, counts, "key", "count", "id", limit).collect()}
        assert got == {i: k.upper() for i, k in enumerate(keys) if k != "unknown"}


def test_time_batches(spark):
    rows = spark.sql("SELECT timestamp'2024-01-01 00:03:59' ts UNION ALL SELECT timestamp'2024-01-01 00:04:00'")
    assert sorted(str(r["batch_start"]) for r in src.time_batches(rows).collect()) == ["2024-01-01 00:02:00", "2024-01-01 00:04:00"]


def test_raw_lines_are_spread_by_their_number(spark, monkeypatch):
    """One file with one row group still gives as many tasks as the number of its rows asks for, each line once."""
    monkeypatch.setattr(inp, "LINES_PER_TASK", 10)
    monkeypatch.setattr(inp, "SMALL_ROWS", 20)
    folder = new_run_dir(spark, "events")
    rows = spark.range(200).selectExpr("id event_id", "timestamp'2024-01-01' ts", "id % 7 user_id", "'click' event_type", "1.0D value", "'{\"k\":1}' props")
    rows.coalesce(1).write.parquet(f"{folder}/events.parquet")
    lines = inp.raw_records(spark, folder)
    assert lines.rdd.getNumPartitions() >= 20
    assert sorted(r["id"] for r in raw.collect_posts(raw.parse_raw(lines)).collect()) == list(range(200))


def test_quotes_under_an_escaped_key(spark):
    inner = '{"text":"b","lang":"en","%s":{"text":"c","lang":"en"}}'
    lines = ['{"id":1,"text":"a","quoted_status":%s}' % (inner % "quoted_status"), '{"id":2,"text":"a","quoted_stat\\u0075s":%s}' % (inner % "quoted_status"), '{"id":3,"text":"quoted_status"}']
    flat = raw.flatten_quotes(raw.parse_raw(spark.createDataFrame([(x,) for x in lines], "raw string")))
    assert sorted((r["id"], r["level"], r["text"]) for r in flat.collect()) == [(1, 2, "a @QUOTED: b @QUOTED: c"), (2, 2, "a @QUOTED: b @QUOTED: c"), (3, 0, "quoted_status")]
