"""One registered query per operator; each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicstream.functions import text as tx
from topicstream.functions.stemmer import stem_words
from topicstream.functions.vectors import round2, scaled_dist, sqdist, vector_sum
from topicstream.operators import batch_clustering as bc
from topicstream.operators import explore as ex
from topicstream.operators import features as fe
from topicstream.operators import model as mo
from topicstream.operators import nearest as ne
from topicstream.operators import quality as qu
from topicstream.operators import word_space as ws
from topicstream.plans import history as hi
from topicstream.plans import inputs as inp
from topicstream.schemas import POST_LINES
from topicstream.session import PLANNER_SETTINGS, new_run_dir, ship_package, staged_table
from topicstream.sources import outputs as out
from topicstream.sources import posts as src
from topicstream.sources import raw
from topicstream.sources import terms
from topicstream.streaming import collect, progress, run

QUERIES = {}

REPLAY_FILES = 4
PHRASES = ("the and", "tion", "Heand", "in her", "over there")


def query(fn):
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        for key, value in PLANNER_SETTINGS.items():
            spark.conf.set(key, value)
        ship_package(spark)
        return fn(spark, sf_dir)

    prepared.__name__, prepared.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = prepared
    return fn


def joined(words: str | Column) -> Column:
    return F.array_join(words, " ")


def docs(spark, sf) -> DataFrame:
    return inp.texts(spark, sf, "documents").withColumnRenamed("doc_id", "id")


# --- sources ------------------------------------------------------------------------------------


@query
def read_posts(spark, sf):
    rows = src.read_posts(spark, inp.post_lines(spark, sf))
    return rows.select("id", "text", joined("urls").alias("urls"), F.size("urls").cast("long").alias("n_urls"))


@query
def stream_posts(spark, sf):
    """All lines through the stream source into a table, one file per micro-batch."""
    lines = src.stream_posts(spark, inp.post_lines(spark, sf))
    path = new_run_dir(spark, "stream")
    sink = lines.writeStream.format("parquet").option("checkpointLocation", f"{path}/progress")
    sink.trigger(availableNow=True).start(f"{path}/posts").awaitTermination()
    return spark.read.parquet(f"{path}/posts").select("id", F.char_length("text").cast("long").alias("chars"), "ts")


@query
def slice_batches(spark, sf):
    rows = src.slice_batches(docs(spark, sf), 50, 10)
    return rows.select("id", "batch_index")


@query
def time_batches(spark, sf):
    rows = src.time_batches(inp.table(spark, sf, "events"))
    return rows.groupBy("batch_start").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@query
def lang_filter_source(spark, sf):
    return src.lang_filter(docs(spark, sf)).select("id", "source", "n_chars")


@query
def read_raw_events(spark, sf):
    """Raw lines written as text and read back; half of each line is no JSON and is set apart."""
    path = new_run_dir(spark, "raw")
    lines = inp.raw_records(spark, sf)
    broken = lines.select(F.substring("raw", F.lit(1), F.length("raw") - 1).alias("raw"))
    lines.unionByName(broken).select(F.col("raw").alias("value")).write.text(path)
    rows = raw.read_raw_events(spark, path)
    good = rows.filter(F.col("record").isNotNull()).select(
        F.try_variant_get("record", "$.id", "bigint").alias("id"), F.lit("parsed").alias("state")
    )
    bad = raw.quarantined(rows).select(
        F.regexp_extract("raw", r'"id":(\d+)', 1).cast("long").alias("id"), F.lit("quarantined").alias("state")
    )
    return good.unionByName(bad)


def _term_lines(spark, sf):
    hosts = inp.table(spark, sf, "pages").select(
        F.translate(F.lower(F.parse_url("url", F.lit("HOST"))), ".", " ").alias("value")
    )
    names = inp.table(spark, sf, "nation").select(F.concat(F.col("n_name"), F.lit(" ")).alias("value"))
    outlets = inp.table(spark, sf, "supplier").select(
        F.concat(F.lit("Outlet - @"), F.translate("s_name", "#", "_")).alias("value")
    )
    return hosts, names, outlets


@query
def read_terms(spark, sf):
    paths = []
    for name, lines in zip(("domains", "keywords", "outlets"), _term_lines(spark, sf)):
        paths.append(new_run_dir(spark, name))
        lines.write.text(paths[-1])
    return terms.read_terms(spark, *paths)


@query
def term_union(spark, sf):
    return terms.term_union(*_term_lines(spark, sf))


@query
def prepared_snapshot(spark, sf):
    root = new_run_dir(spark, "prepared")
    src.prepared_snapshot(docs(spark, sf), root, sf, 40, 5)
    again = src.prepared_snapshot(docs(spark, sf), root, sf, 40, 5)
    return again.select("id", "batch_index", "source")


@query
def take_n(spark, sf):
    return src.take_n(docs(spark, sf), 500).select("id", "source", "n_chars")


@query
def posts_table_scan(spark, sf):
    collected = raw.extract_entities(raw.flatten_quotes(raw.drop_control_records(raw.parse_raw(inp.raw_records(spark, sf)))))
    return src.posts_table_scan(collected).select("id", "text", F.array_join("hashtags", ",").alias("hashtags"))


# --- sinks --------------------------------------------------------------------------------------


@query
def write_cluster_info(spark, sf):
    _, rows = inp.stored(inp.report(spark, sf), "cluster_info")
    return rows.select("batch_id", "cluster_id", "count", "rep_id")


@query
def write_assignments(spark, sf):
    _, rows = inp.stored(inp.assigned(spark, sf), "assignments")
    return rows.select("batch_id", "cluster_id", "id", "text")


def _collisions(spark, sf):
    """Distinct (bucket, word) per batch, as the online job stores them."""
    cleaned = fe.clean_tokens(inp.posts(spark, sf)).withColumn("batch_id", F.pmod("id", F.lit(inp.BATCHES)))
    rows = fe.token_buckets(cleaned.select("batch_id", F.array_distinct("tokens").alias("tokens")))
    return rows.distinct()


@query
def write_collisions(spark, sf):
    _, rows = inp.stored(_collisions(spark, sf), "collisions")
    return rows.select("batch_id", "bucket", "word")


@query
def write_posts(spark, sf):
    posts = raw.collect_posts(raw.parse_raw(inp.raw_records(spark, sf)))
    root = new_run_dir(spark, "posts")
    out.write_posts(posts, root, 0)
    lines = spark.read.schema(posts.schema).json(f"{root}/post_lines")
    return out.read_batches(spark, root, "posts").join(lines.select("id", F.col("text").alias("line_text")), "id").select(
        "id", "text", "line_text", "hashtags", "urls", "user_mentions"
    )


def _collected_stream(spark, sf) -> str:
    """Raw lines through the collector, started twice on the same folders.

    First the event lines and a broken half of each, then, as later files, the same ids with other texts and one line without an id.
    """
    source, root = new_run_dir(spark, "raw"), new_run_dir(spark, "collector")
    lines = inp.raw_records(spark, sf)
    broken = lines.select(F.substring("raw", F.lit(1), F.length("raw") - 1).alias("raw"))
    late = lines.select(F.regexp_replace("raw", '"text":"', '"text":"late ').alias("raw"))
    nameless = late.select(F.regexp_replace("raw", r'"id":(\d+),"text"', '"number":$1,"text"').alias("raw"))
    for number, part in enumerate((lines.unionByName(broken), late.unionByName(nameless))):
        part.select(F.col("raw").alias("value")).write.text(f"{source}/part={number}")
        for running in collect.collect(spark, f"{source}/*", root):
            running.awaitTermination()
    return root


@query
def collect_stream(spark, sf):
    """Posts and lines the collector stored: every id once, in its first form."""
    root = _collected_stream(spark, sf)
    posts = out.read_batches(spark, root, "posts")
    lines = spark.read.schema(POST_LINES).json(f"{root}/post_lines")
    lines = lines.select("id", F.col("text").alias("line_text"))
    return posts.join(lines, "id").select("id", "text", "line_text", "user_name", "hashtags", "urls", "timestamp", "user_mentions")


@query
def collect_quarantine(spark, sf):
    """Lines the collector set apart, with the reason."""
    bad = spark.read.parquet(f"{_collected_stream(spark, sf)}/quarantine")
    number = F.regexp_extract("raw", r'"(?:id|number)":(\d+)', 1).cast("long")
    return bad.select(number.alias("id"), "reason")


@query
def merge_sink(spark, sf):
    root, rows = inp.stored(inp.report(spark, sf), "cluster_info")
    merged = hi.merge_cluster_info(rows)
    out.merge_sink(merged, root, "cluster_info")
    return out.merge_sink(merged, root, "cluster_info").select("batch_id", "cluster_id", "count")


@query
def reset_outputs(spark, sf):
    """Two runs over the same posts: the second one starts from empty outputs."""
    rows = inp.report(spark, sf).persist()
    counts = []
    for name in ("first", "second"):
        _, stored = inp.stored(rows, "cluster_info")
        counts.append(stored.agg(F.count("*").alias("rows")).select(F.lit(name).alias("run"), "rows"))
    return counts[0].unionByName(counts[1])


@query
def read_batch_outputs(spark, sf):
    root, _ = inp.stored(inp.report(spark, sf), "cluster_info")
    rows = out.read_batches(spark, root, "cluster_info")
    return rows.groupBy("batch_id").agg(F.count("*").alias("clusters"), F.sum("count").alias("posts"))


@query
def read_merged(spark, sf):
    root, rows = inp.stored(inp.assigned(spark, sf), "assignments")
    merged = out.merge_sink(hi.merge_assignments(rows), root, "assignments")
    return merged.groupBy("batch_id", "cluster_id").agg(F.count("*").alias("posts"), F.min("id").alias("first_id"))


# --- records ------------------------------------------------------------------------------------


@query
def drop_control_records(spark, sf):
    rows = raw.drop_control_records(raw.parse_raw(inp.raw_records(spark, sf)))
    return rows.select(F.try_variant_get("record", "$.id", "bigint").alias("id"))


@query
def flatten_quotes(spark, sf):
    flat = raw.flatten_quotes(raw.parse_raw(inp.thread_records(spark, sf)))
    author = F.try_variant_get("user", "$.screen_name", "string").alias("author")
    return flat.select("id", "text", "timestamp_ms", F.col("level").cast("long").alias("level"), author)


@query
def extract_entities(spark, sf):
    flat = raw.flatten_quotes(raw.drop_control_records(raw.parse_raw(inp.raw_records(spark, sf))))
    rows = raw.extract_entities(flat)
    return rows.select("id", *[F.array_join(c, ",").alias(c) for c in ("hashtags", "urls", "mentions")])


@query
def project_post(spark, sf):
    return raw.collect_posts(raw.parse_raw(inp.raw_records(spark, sf)))


@query
def track_filter(spark, sf):
    """Phrases from a table: a fixed few and the first two words of every benchmark item."""
    fixed = spark.createDataFrame([(p,) for p in PHRASES], "term string")
    first = F.array_join(F.slice(F.split("text", " "), 1, 2), " ")
    listed = fixed.unionByName(inp.table(spark, sf, "benchmark").select(first.alias("term")))
    return terms.track_filter(docs(spark, sf), listed).select("id", "lang")


@query
def nonempty_guard(spark, sf):
    """An empty batch leaves no outputs and keeps the model; the next batch runs as usual."""
    posts = inp.posts(spark, sf)
    root = run.new_run(spark)
    run.step(posts.filter(F.col("source") < 0), 0, root)
    run.step(posts, 1, root)
    return out.read_batches(spark, root, "batch_summary").select("batch_id", "posts", "unclustered")


@query
def empty_intervals(spark, sf):
    """Two batches without posts after a stored model: the clusters lose weight, and the light ones expire."""
    root = run.new_run(spark)
    run.write_model(inp.label_model(inp.embeddings(spark, sf)), run.ModelState(next_id=100), root, 0)
    none = inp.posts(spark, sf).filter(F.col("source") < 0)
    settings = run.StreamSettings(min_weight=20.0)
    for batch in (1, 2):
        run.step(none, batch, root, settings)
    return run.read_model(spark, root, 2)[0].select("cluster_id", F.round("weight", 6).alias("weight"))


@query
def filter_collisions(spark, sf):
    merged = fe.filter_collisions(fe.merge_buckets(fe.bucket_words(fe.clean_tokens(inp.posts(spark, sf)), 20000)))
    return merged.select("bucket", "word", "n_words")


@query
def interesting_flag(spark, sf):
    rows = qu.cluster_scores(inp.assigned(spark, sf))
    flag = qu.interesting_flag(F.col("count"), F.col("silhouette")).alias("interesting")
    return rows.select("cluster_id", "count", flag)


@query
def interesting_history(spark, sf):
    rows = hi.interesting_history(inp.event_report(spark, sf))
    return rows.select("batch_id", "cluster_id", "count", "interesting")


@query
def drilldown(spark, sf):
    _, rows = inp.stored(inp.assigned(spark, sf), "assignments")
    return hi.drilldown(rows, 3, 1).select("batch_id", "cluster_id", "id", "text")


# --- text ---------------------------------------------------------------------------------------


@query
def tokenize(spark, sf):
    words = F.filter(tx.tokenize(F.col("text")), lambda w: w != "")
    return docs(spark, sf).select("id", joined(words).alias("tokens"))


@query
def stem_tokens(spark, sf):
    words = F.filter(tx.stem_tokens(tx.tokenize(F.col("text"))), lambda w: w != "")
    return docs(spark, sf).select("id", joined(words).alias("tokens"))


@query
def stem_english(spark, sf):
    """Posts and occurrences per English stem and word; every distinct word is stemmed once."""
    words = docs(spark, sf).select("id", F.explode(tx.tokenize(F.col("text"))).alias("word")).filter("word <> ''")
    rows = stem_words(words.groupBy("word").agg(F.count("*").alias("n"), F.countDistinct("id").alias("posts")))
    return rows.select("word", "stem", "n", "posts")


@query
def sanitize_tokens(spark, sf):
    words = tx.sanitize_tokens(tx.tokenize(F.col("text")))
    return docs(spark, sf).select("id", joined(words).alias("tokens"))


@query
def remove_stopwords(spark, sf):
    words = F.filter(tx.remove_stopwords(tx.tokenize(F.col("text"))), lambda w: w != "")
    return docs(spark, sf).select("id", joined(words).alias("tokens"))


@query
def clean_tokens(spark, sf):
    rows = fe.clean_tokens(inp.posts(spark, sf))
    return rows.select("id", joined("tokens").alias("tokens"), F.size("tokens").cast("long").alias("n"))


@query
def hash_bucket(spark, sf):
    words = docs(spark, sf).select(F.explode(tx.tokenize(F.col("text"))).alias("word")).distinct()
    return words.select("word", tx.hash_bucket(F.col("word"), 100).alias("bucket"))


@query
def term_frequency(spark, sf):
    return fe.term_frequency(inp.posts(spark, sf))


@query
def idf_weight(spark, sf):
    rows = fe.idf_weight(inp.posts(spark, sf))
    return rows.select("id", "bucket", F.round("w", 6).alias("w"))


@query
def collision_map(spark, sf):
    rows = fe.collision_map(fe.clean_tokens(inp.posts(spark, sf)))
    return rows.select("id", "bucket", joined("words").alias("words"))


@query
def collision_report(spark, sf):
    return fe.collision_report(inp.posts(spark, sf))


@query
def clean_text_regex(spark, sf):
    return docs(spark, sf).select("id", tx.clean_text(F.col("text")).alias("clean"))


@query
def stem_text(spark, sf):
    return docs(spark, sf).select("id", tx.stem_text(F.col("text")).alias("stemmed"))


@query
def tfidf_l2(spark, sf):
    rows = ex.tfidf_l2(inp.posts(spark, sf))
    return rows.select("id", "word", F.round("w", 6).alias("w"))


def _word_space(spark, sf):
    return ws.word_space(ex.tfidf_l2(inp.posts(spark, sf), numbered=True))


@query
def lsa_reduce(spark, sf):
    """Without signs, which a singular vector does not have."""
    rows = ws.lsa_reduce(_word_space(spark, sf))
    size = lambda i: F.round(F.abs(F.col("reduced")[i]), 4)
    return rows.select("id", size(0).alias("x"), size(1).alias("y"))


# --- vectors and joins --------------------------------------------------------------------------


def _with_own_center(spark, sf):
    rows = staged_table(inp.features(spark, sf), "features")
    model = inp.source_model(rows).select(F.col("cluster_id").alias("source"), "center")
    return rows.join(model, "source")


@query
def sqdist_(spark, sf):
    return _with_own_center(spark, sf).select("id", F.round(sqdist(F.col("tfidf"), F.col("center")), 4).alias("d"))


@query
def vector_sum_(spark, sf):
    rows = inp.embeddings(spark, sf)
    return rows.select("id", F.round(vector_sum(F.col("tfidf")), 6).alias("total"))


@query
def scaled_dist_(spark, sf):
    d = scaled_dist(F.col("tfidf"), F.col("center"), F.col("vec_sum"))
    return _with_own_center(spark, sf).select("id", F.round(d, 4).alias("d"))


@query
def predict(spark, sf):
    rows = inp.embeddings(spark, sf)
    hits = ne.predict(rows.drop("cluster_id"), inp.label_model(rows))
    return hits.select("id", "cluster_id", F.round("sq_dist", 6).alias("dist"))


@query
def round2_(spark, sf):
    rows = inp.table(spark, sf, "lineitem")
    ratio = F.when(F.col("l_discount") == 0, F.lit(math.inf)).otherwise(F.col("l_tax") / F.col("l_discount"))
    return rows.groupBy(round2(ratio).alias("ratio")).agg(F.count("*").alias("n"))


@query
def join_posts_clusters(spark, sf):
    rows = inp.assigned(spark, sf)
    return rows.select("id", "cluster_id", F.char_length("text").cast("long").alias("chars"))


@query
def join_vectors(spark, sf):
    rows = inp.assigned(spark, sf)
    return rows.select("id", "cluster_id", F.round("vec_sum", 4).alias("vec_sum"), F.round("own", 4).alias("own"))


@query
def join_neighbor(spark, sf):
    rows = inp.assigned(spark, sf).filter(F.col("cluster_id").isNotNull())
    return rows.select("id", "cluster_id", "neighbor_id", F.round("other", 4).alias("other"))


@query
def nearest_neighbor_center(spark, sf):
    model = inp.label_model(inp.embeddings(spark, sf))
    rows = ne.nearest_neighbor_center(model)
    return rows.select("cluster_id", "neighbor_id", F.round("neighbor_dist", 6).alias("dist"))


@query
def center_pairs(spark, sf):
    rows = staged_table(inp.features(spark, sf), "features")
    pairs = ne.center_pairs(inp.source_model(rows), 25.0)
    return pairs.select("id_i", "id_j", F.round("dist", 4).alias("dist"))


@query
def distant_candidates(spark, sf):
    rows = staged_table(inp.features(spark, sf), "features")
    return mo.distant_candidates(rows, inp.source_model(rows), 1.0).select("id")


def _collected(lines):
    return src.posts_from_lines(raw.collect_posts(raw.parse_raw(lines)))


def _mentioning(lines):
    return raw.own_entities(raw.drop_control_records(raw.parse_raw(inp.quoting_records(lines))))


@query
def mention_counts(spark, sf):
    return ex.mention_counts(_mentioning(inp.raw_records(spark, sf)))


@query
def top_mentions(spark, sf):
    return ex.top_mentions(ex.mention_counts(_mentioning(inp.raw_records(spark, sf))), 20)


@query
def author_reach(spark, sf):
    lines = inp.raw_records(spark, sf)
    return ex.author_reach(ex.mention_counts(_mentioning(lines)), _collected(lines))


def _groups(spark, sf):
    return ex.duplicate_groups(docs(spark, sf).select("id", "text"))


@query
def duplicate_groups(spark, sf):
    return _groups(spark, sf)


@query
def propagate_labels(spark, sf):
    labels = inp.table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    return ex.propagate_labels(_groups(spark, sf), labels)


@query
def update_labels(spark, sf):
    labels = inp.table(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    posts = docs(spark, sf).select("id", "source", F.lit(None).cast("int").alias("quality"))
    return ex.update_labels(posts, labels, "quality")


# --- quality ------------------------------------------------------------------------------------


@query
def cluster_quality(spark, sf):
    return qu.cluster_quality(inp.assigned(spark, sf))


@query
def scaled_quality(spark, sf):
    rows = qu.cluster_scores(inp.assigned(spark, sf))
    return rows.select("cluster_id", "count", *[F.round(c, 4).alias(c) for c in ("intra", "inter", "silhouette")])


@query
def representative(spark, sf):
    return qu.representative(inp.assigned(spark, sf))


@query
def best_url(spark, sf):
    pages = inp.table(spark, sf, "pages")
    rows = pages.select(
        F.pmod("page_id", F.lit(10)).alias("cluster_id"), F.array(F.parse_url("url", F.lit("HOST"))).alias("urls")
    )
    return qu.best_url(rows)


@query
def batch_summary(spark, sf):
    rows = qu.batch_summary(inp.report(spark, sf), ["batch_id"])
    return rows.withColumn("avg_silhouette", F.round("avg_silhouette", 6))


@query
def used_clusters(spark, sf):
    return qu.used_clusters(inp.assigned(spark, sf))


@query
def rank_by_silhouette(spark, sf):
    return qu.rank_by_silhouette(inp.report(spark, sf)).select("batch_id", "cluster_id", "silhouette")


@query
def collision_merge(spark, sf):
    return fe.merge_buckets(_collisions(spark, sf))


@query
def cluster_sizes_topk(spark, sf):
    return ex.cluster_sizes(docs(spark, sf), "source", 10)


@query
def cluster_cohesion(spark, sf):
    rows = ex.cluster_cohesion(inp.posts(spark, sf).withColumnRenamed("source", "cluster_id"))
    return rows.withColumn("score", F.round("score", 6))


@query
def top_cohesion(spark, sf):
    posts = inp.posts(spark, sf).withColumnRenamed("source", "cluster_id")
    groups = ex.duplicate_groups(posts)
    reps = ex.distinct_texts(groups).withColumnRenamed("rep_id", "id")
    firsts = posts.join(reps, "id")
    duplicates = firsts.groupBy("cluster_id").agg(F.sum("duplicates").alias("duplicates"))
    rows = ex.top_cohesion(ex.cluster_cohesion(firsts), duplicates, 20)
    return rows.withColumn("score", F.round("score", 6))


@query
def hashtag_eval(spark, sf):
    rows = inp.table(spark, sf, "events").withColumn("cluster", F.col("user_id") % 10)
    result = ex.hashtag_eval(rows, "cluster", "event_type", "event_id")
    return result.select(F.round("within", 6).alias("within"), F.round("cross", 9).alias("cross"), "empty")


@query
def hashtag_eval_rows(spark, sf):
    """Tags by key number, so that many are rare: the flags of every row."""
    tag = F.concat("event_type", F.get_json_object("props", "$.k"))
    rows = inp.table(spark, sf, "events").select("event_id", F.col("user_id").alias("cluster"), tag.alias("tag"))
    return ex.hashtag_eval_rows(rows, "cluster", "tag", "event_id")


@query
def top_terms(spark, sf):
    posts = inp.posts(spark, sf)
    rows = ex.top_terms(ex.tfidf_l2(posts), posts.select("id", F.col("source").alias("cluster_id")))
    return rows.withColumn("weight", F.round("weight", 6))


@query
def upsert_posts(spark, sf):
    """The documents three times, under the same arrival and a later one with other texts; half are stored already."""
    rows = docs(spark, sf).select("id", "text", F.col("id").alias("arrival"))
    later = rows.select("id", F.lit("late").alias("text"), (F.col("arrival") + 10_000_000).alias("arrival"))
    stored = inp.table(spark, sf, "labels").select(F.col("doc_id").alias("id"))
    tied = rows.withColumn("text", F.concat("text", F.lit("~")))
    return raw.upsert_posts(tied.unionByName(later).unionByName(rows), "arrival", stored).select("id", "text")


@query
def vector_mean(spark, sf):
    rows = mo.vector_mean(inp.embeddings(spark, sf))
    return rows.select(
        "cluster_id", "n", F.round(vector_sum(F.col("total")), 4).alias("total"), F.round(F.col("total")[0], 4).alias("first")
    )


@query
def throughput(spark, sf):
    """Rows, duration and rate of every micro-batch of a stream, stored by a listener and held against each other."""
    lines = src.stream_posts(spark, inp.post_lines(spark, sf))
    path = new_run_dir(spark, "stream")
    sink = lines.writeStream.format("parquet").option("checkpointLocation", f"{path}/progress").option("path", f"{path}/posts")
    progress.finish(progress.start_observed(spark, sink.trigger(availableNow=True), path))
    apart = F.abs(F.col("posts") / F.col("posts_per_second") - F.col("seconds"))  # two clocks, read milliseconds apart
    return progress.throughput(spark, path).agg(
        F.sum("posts").alias("posts"),
        F.count_if((F.col("seconds") <= 0) | (apart > 0.05 + 0.02 * F.col("seconds"))).alias("disagreements"),
        F.max(F.col("batch_id") + 1).alias("last_batch"),
        F.count("*").alias("batches"),
    ).select("posts", "disagreements", (F.col("batches") == F.col("last_batch")).alias("all_stored"))


# --- history ------------------------------------------------------------------------------------


@query
def batch_index(spark, sf):
    return hi.batch_index(inp.event_report(spark, sf))


@query
def history_grid(spark, sf):
    rows = hi.history_grid(staged_table(inp.event_report(spark, sf), "report"))
    return rows.select("cluster_id", "batch_index", "count", "silhouette", "rep_id", "best_url")


@query
def group_by_cluster(spark, sf):
    rows = hi.group_by_cluster(hi.history_grid(staged_table(inp.event_report(spark, sf), "report")))
    counts = F.transform("cells", lambda c: F.concat_ws(":", c["batch_index"].cast("string"), c["count"].cast("string")))
    return rows.select("cluster_id", F.array_join(counts, " ").alias("cells"))


@query
def post_link(spark, sf):
    rows = hi.with_post_link(inp.report(spark, sf), "https://posts.example/status/")
    return rows.select("batch_id", "cluster_id", "rep_link")


@query
def merge_cluster_info(spark, sf):
    return hi.merge_cluster_info(inp.report(spark, sf))


@query
def merge_assignments(spark, sf):
    return hi.merge_assignments(inp.assigned(spark, sf))


@query
def merge_collisions(spark, sf):
    return hi.merge_collisions(_collisions(spark, sf))


# --- the online model ---------------------------------------------------------------------------


@query
def init_model(spark, sf):
    """Against the empty model every post with a positive sum is a candidate."""
    return mo.distant_candidates(inp.features(spark, sf), mo.empty_model(spark)).select("id")


@query
def init_random(spark, sf):
    """As many drawn centers as there are labels, of the embeddings' length, numbered after the highest label."""
    model = inp.label_model(inp.embeddings(spark, sf))
    facts = model.agg(F.count("*").alias("k"), F.max(F.size("center")).alias("dims"), F.max("cluster_id").alias("top")).head()
    drawn, _ = mo.random_model(spark, facts["k"], facts["dims"], facts["top"] + 1, weight=2.0, seed=7)
    cells = mo.model_append(model, drawn).filter(F.col("cluster_id") > facts["top"])
    return cells.select("cluster_id", "weight", F.posexplode("center").alias("i", "x")).select("cluster_id", "weight", "i", F.round("x", 6).alias("x"))


@query
def add_clusters(spark, sf):
    rows = staged_table(inp.features(spark, sf).select("id", "tfidf", "vec_sum"), "features")
    model, _ = mo.add_clusters(rows, mo.empty_model(spark), 1)
    return model.select("cluster_id", "weight", F.round(vector_sum(F.col("center")), 4).alias("total"))


@query
def model_append(spark, sf):
    model = inp.label_model(inp.embeddings(spark, sf))
    more = model.withColumn("cluster_id", F.col("cluster_id") + 100).withColumn("weight", F.lit(0.0))
    return mo.model_append(model, more).select("cluster_id", "weight")


@query
def model_remove(spark, sf):
    model = inp.label_model(inp.embeddings(spark, sf))
    light = model.filter(F.col("weight") < model.agg(F.avg("weight")).scalar())
    return mo.model_remove(model, light).select("cluster_id", "weight")


@query
def train_step(spark, sf):
    rows = inp.embeddings(spark, sf)
    model = mo.train_step(rows.drop("cluster_id"), inp.label_model(rows), 0.7)
    return model.select(
        "cluster_id",
        F.round("weight", 4).alias("weight"),
        F.round(vector_sum(F.col("center")), 6).alias("total"),
        F.round(vector_sum(F.transform("center", lambda x: x * x)), 6).alias("norm2"),
    )


@query
def expire_clusters(spark, sf):
    rows = inp.embeddings(spark, sf)
    model = staged_table(mo.train_step(rows.drop("cluster_id"), inp.label_model(rows), 0.7), "trained")
    limit = model.agg(F.avg("weight")).head()[0]
    return mo.expire_clusters(model, limit).select("cluster_id", F.round("weight", 4).alias("weight"))


@query
def keep_one(spark, sf):
    """All clusters of the first batch expire in it; the second one starts from nothing, with ids after those of the first."""
    posts, root = inp.posts(spark, sf), run.new_run(spark)
    run.step(posts, 0, root, run.StreamSettings(min_weight=math.inf))
    run.step(posts, 1, root, run.StreamSettings(merge_threshold=0.0, min_weight=0.0))
    model, _ = run.read_model(spark, root, 0)
    return run.read_model(spark, root, 1)[0].unionByName(model).select("cluster_id")


@query
def merge_clusters(spark, sf):
    """Every embedding as a center, the label as its weight."""
    rows = inp.embeddings(spark, sf)
    model = rows.select(
        F.col("id").alias("cluster_id"), F.col("tfidf").alias("center"), (F.col("cluster_id") + 1.0).alias("weight")
    )
    return mo.merge_clusters(model, 1.2).select("cluster_id", "weight")


@query
def stable_id(spark, sf):
    """Ids do not move when other clusters go: posts of removed clusters fall to the remaining ids."""
    rows = inp.embeddings(spark, sf)
    model = inp.label_model(rows)
    light = model.filter(F.col("weight") < model.agg(F.avg("weight")).scalar())
    hits = ne.predict(rows.drop("cluster_id"), staged_table(mo.model_remove(model, light), "left"))
    return hits.select("id", "cluster_id")


@query
def assign_after_update(spark, sf):
    """One online step over all posts: stored assignments agree with the stored model version."""
    posts = inp.posts(spark, sf)
    root = run.new_run(spark)
    run.step(posts, 0, root)
    model, _ = run.read_model(spark, root, 0)
    stored = out.read_batch(spark, root, "assignments", 0).select("id", F.col("cluster_id").alias("stored"))
    again = ne.predict(inp.features(spark, sf).select("id", "vec_sum", "tfidf"), model)
    again = again.filter(F.col("vec_sum") > 0).join(stored, "id")
    return again.agg(
        F.count("*").alias("posts"), F.count_if(~F.col("cluster_id").eqNullSafe(F.col("stored"))).alias("differences")
    )


@query
def run_stream(spark, sf):
    """The whole online job over all documents in three micro-batches, from JSON line files, as many per trigger as a batch has."""
    posts = inp.posts(spark, sf)
    size = -(-posts.count() // 3)
    sliced = src.slice_batches(posts, size, 3)
    source = new_run_dir(spark, "replay")
    urls = F.when(F.size("urls") > 0, F.array_join("urls", ",")).alias("urls")
    lines = sliced.select("id", "text", urls, "batch_index").persist()
    for batch in range(3):  # files are taken in the order in which they were written
        part = lines.filter(F.col("batch_index") == batch).drop("batch_index")
        part.repartition(REPLAY_FILES).write.json(f"{source}/part={batch}")
    lines.unpersist()
    root = run.new_run(spark)
    progress.finish(run.run_stream(src.stream_posts(spark, f"{source}/*", REPLAY_FILES), root))
    rows = qu.rank_by_silhouette(out.read_batches(spark, root, "cluster_info"))
    return rows.select("batch_id", "cluster_id", "count", "silhouette", "intra", "inter", "interesting", "rep_id", "best_url")


# --- batch clustering ---------------------------------------------------------------------------


@query
def kmeans_batch(spark, sf):
    return ws.kmeans_labels(_word_space(spark, sf), k=75)


@query
def silhouette_sweep(spark, sf):
    rows = ws.silhouette_sweep(_word_space(spark, sf), [5, 10, 20])
    return rows.withColumn("silhouette", F.round("silhouette", 6))


@query
def explore_clusters(spark, sf):
    """The exploration job: k-means labels over word weights go through sizes, words, cohesion, purity and duplicates."""
    posts = inp.posts(spark, sf)
    vectors, words = ex.word_vectors(posts)
    labels = staged_table(ws.kmeans_labels(ws.word_space(vectors), k=20), "labels").select("id", F.col("label").cast("long").alias("cluster_id"))
    labelled = posts.join(labels, "id")
    groups = ex.duplicate_groups(posts)
    shared = ex.propagate_labels(groups, labels.withColumnRenamed("cluster_id", "label")).groupBy(F.col("label").alias("cluster_id")).agg(F.count("*").alias("with_copies"))
    first = ex.top_terms(vectors, labels, clusters=20, terms=1, words=words).select("cluster_id", F.col("word").alias("top_word"))
    tagged = ex.hashtag_eval_rows(labelled.withColumn("tag", F.col("source").cast("string")), "cluster_id", "tag", "id")
    purity = tagged.groupBy("cluster_id").agg(F.count_if("wrong_within").alias("wrong"))
    sizes = labels.groupBy("cluster_id").agg(F.count("*").alias("size"))
    cohesion = ex.cluster_cohesion(labelled).select("cluster_id", F.round("score", 6).alias("score"))
    rows = sizes.join(first, "cluster_id", "left").join(purity, "cluster_id", "left").join(cohesion, "cluster_id", "left")
    return rows.join(shared, "cluster_id", "left").select("cluster_id", "size", "top_word", "wrong", "score", "with_copies")


@query
def dbscan(spark, sf):
    return bc.dbscan(ex.tfidf_l2(inp.posts(spark, sf)))


for _name in ("sqdist_", "vector_sum_", "scaled_dist_", "round2_"):
    QUERIES[_name.rstrip("_")] = QUERIES.pop(_name)
