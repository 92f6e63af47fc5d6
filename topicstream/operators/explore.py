"""Exploration reports over stored posts: duplicates, word weights, cluster purity and mentions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicstream.functions.text import STOP_WORDS, clean_text, plain_words, stem_text, word_counts
from topicstream.operators.skew import HOT_ROWS, join_per_key, with_position
from topicstream.session import new_run_dir, scratch, staged_table

OFTEN_WORDS = 200_000


def normal_text(text: Column) -> Column:
    """Two posts are duplicates if this form is equal: links and mentions removed, words stemmed."""
    return stem_text(clean_text(text))


def duplicate_groups(posts: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(id, rep_id, copies): every post with the first post of the same text and the group's size.

    Kept as one row per post, since one text may make up a large share of all posts. Texts are compared by
    their SHA-256 digest, so the shuffles carry digests and ids only.
    """
    digest = F.unhex(F.sha2(normal_text(F.col("text")), 256)).alias("digest")
    keyed = staged_table(posts.select("id", digest), "digests")  # the texts are read once
    groups = keyed.groupBy("digest").agg(F.min("id").alias("rep_id"), F.count("*").alias("copies"))
    groups = groups.withColumn("n", F.col("copies"))
    return join_per_key(keyed, groups, "digest", "n", "id", hot_rows).select("id", "rep_id", "copies")


def distinct_texts(groups: DataFrame) -> DataFrame:
    """One row per group of equal texts: (rep_id, duplicates)."""
    reps = groups.filter(F.col("id") == F.col("rep_id"))
    return reps.select("rep_id", (F.col("copies") - 1).alias("duplicates"))


def propagate_labels(groups: DataFrame, labels: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(id, label): every post gets the label of its group's first post, where that one has a label."""
    per_rep = labels.join(distinct_texts(groups).withColumnRenamed("rep_id", "id"), "id")
    per_rep = per_rep.select(F.col("id").alias("rep_id"), "label", (F.col("duplicates") + 1).alias("n"))
    return join_per_key(groups.select("id", "rep_id"), per_rep, "rep_id", "n", "id", hot_rows).select("id", "label")


def update_labels(posts: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """A new version of ``posts`` with ``column`` set from (id, label); other posts keep their value."""
    new = labels.select("id", F.col("label").alias("_label"))
    old = F.col(column) if column in posts.columns else F.lit(None)
    joined = posts.join(new, "id", "left")
    return joined.withColumn(column, F.coalesce("_label", old)).drop("_label")


def cluster_sizes(posts: DataFrame, column: str, k: int = 10) -> DataFrame:
    sizes = posts.groupBy(column).agg(F.count("*").alias("size"))
    return sizes.orderBy(F.desc("size"), column).limit(k)


def _counted(posts: DataFrame, stop_words: tuple[str, ...]) -> tuple[DataFrame, DataFrame | None]:
    """(id, counts): word counts per post, formed inside its row. Posts that share an id are merged by a shuffle into rows (id, word, n) beside."""
    ids = posts.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1")
    shared = staged_table(ids.select(F.col("id").alias("shared")), "shared-ids")
    counted = lambda rows: rows.select("id", word_counts(plain_words(F.col("text"), stop_words)).alias("counts"))
    texts = posts.select("id", "text")
    if shared.isEmpty():
        return counted(texts), None
    same = texts["id"].eqNullSafe(shared["shared"])
    rows = counted(texts.join(shared, same, "left_semi")).select("id", F.inline("counts"))
    return counted(texts.join(shared, same, "left_anti")), rows.groupBy("id", "word").agg(F.sum("n").alias("n"))


def word_rows(posts: DataFrame, stop_words: tuple[str, ...] = STOP_WORDS) -> DataFrame:
    """(id, word, n): word counts per post. Only the words of posts that share an id are shuffled."""
    alone, merged = _counted(posts, stop_words)
    rows = alone.select("id", F.inline("counts"))
    return rows if merged is None else rows.unionByName(merged)


def tfidf_l2(
    posts: DataFrame, min_df: int = 2, max_df: float = 0.5, stop_words: tuple[str, ...] = STOP_WORDS, often: int = OFTEN_WORDS,
    numbered: bool = False,
) -> DataFrame:
    """(id, word, w): smooth TF-IDF of the words in at least ``min_df`` posts and at most the share
    ``max_df`` of them, scaled to length 1 per post.

    The weights of frequent words, at most ``often`` of them, are broadcast, so that most counts get theirs where they are; the counts
    of the other words meet theirs in a shuffled join. ``numbered`` gives (id, at, w): one row per post with lists of the numbers
    and weights of its words, the most frequent word being 0, as a stored table; posts without a counted word have no row."""
    if numbered:
        return word_vectors(posts, min_df, max_df, stop_words, often)[0]
    counts = staged_table(word_rows(posts, stop_words), "word-counts")  # used for the weights and for their df
    total = posts.agg(F.count("*")).scalar()
    df = staged_table(counts.groupBy("word").agg(F.count("*").alias("df")).withColumn("m", total), "word-frequencies")
    kept = (F.col("df") >= min_df) & (F.col("df") <= max_df * F.col("m"))
    known = df.select("word", "df", F.when(kept, F.log((1 + F.col("m")) / (1 + F.col("df"))) + 1).alias("idf"))
    limit = max(100, -(-counts.count() // often))  # no more than ``often`` words can be in more posts
    hot = F.broadcast(known.filter(F.col("df") > limit).select("word", "idf"))
    cold = known.filter((F.col("df") <= limit) & F.col("idf").isNotNull()).select("word", "idf")
    rare = counts.join(hot.select("word"), "word", "left_anti").join(cold, "word")
    weighted = counts.join(hot, "word").filter(F.col("idf").isNotNull()).unionByName(rare)
    raw = weighted.select("id", "word", (F.col("n") * F.col("idf")).alias("w"))
    # a window over the words of one post, whose number is bounded by the post's text
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("id")))
    return raw.withColumn("w", F.col("w") / length)


def _lengths(lists: pa.Array) -> np.ndarray:
    return pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)


def _listed(lengths: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)), pa.int32()), values)


def _scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, at, w) of length 1 in the order of the numbers, from (id, at, w) and the list ``more`` of (at, w); posts without a word go."""
    for batch in (b.slice(n, 1024) for b in batches for n in range(0, b.num_rows, 1024)):
        rows, both = np.arange(batch.num_rows), [batch.column("at"), batch.column("more")]
        owner = np.concatenate([np.repeat(rows, _lengths(lists)) for lists in both])
        more_at, more_w = both[1].flatten().flatten()
        at, w = np.concatenate([both[0].flatten(), more_at]), np.concatenate([batch.column("w").flatten(), more_w])
        order = np.lexsort((at, owner))
        owner, at, w = owner[order], at[order], w[order]
        w = w / np.sqrt(np.bincount(owner, w * w, batch.num_rows))[owner]
        lengths = np.bincount(owner, minlength=batch.num_rows)
        some = lengths > 0
        lists = [_listed(lengths[some], pa.array(v, kind)) for v, kind in ((at, pa.int64()), (w, pa.float64()))]
        yield pa.RecordBatch.from_arrays([batch.column("id").filter(pa.array(some)), *lists], ["id", "at", "w"])


def word_vectors(
    posts: DataFrame, min_df: int = 2, max_df: float = 0.5, stop_words: tuple[str, ...] = STOP_WORDS, often: int = OFTEN_WORDS
) -> tuple[DataFrame, DataFrame]:
    """The numbered form of ``tfidf_l2`` and its words (word, at), both stored; no other table of this step stays."""
    spark = posts.sparkSession
    paths = [new_run_dir(spark, name) for name in ("word-vectors", "vocabulary")]
    with scratch(spark):
        tables = _numbered(posts, min_df, max_df, stop_words, often)
        for df, path in zip(tables, paths):
            df.write.parquet(path)
    return tuple(spark.read.schema(df.schema).parquet(path) for df, path in zip(tables, paths))


def _numbered(posts: DataFrame, min_df: int, max_df: float, stop_words: tuple[str, ...], often: int) -> tuple[DataFrame, DataFrame]:
    """The counts stay in the post's row, where the frequent words get numbers and weights from a broadcast; only the other words become
    rows, meet theirs by word and come back by id."""
    lists, merged = _counted(posts, stop_words)
    if merged is not None:
        lists = lists.unionByName(merged.groupBy("id").agg(F.collect_list(F.struct("word", "n")).alias("counts")))
    lists = staged_table(lists, "word-lists")
    total = posts.agg(F.count("*")).scalar()
    df = lists.select(F.explode("counts.word").alias("word")).groupBy("word").agg(F.count("*").alias("df")).withColumn("m", total)
    df = staged_table(df, "word-frequencies")
    spot = (F.pmod(F.xxhash64("word"), F.lit(1 << 32)) / (1 << 32) - F.col("df")).alias("order")
    idf = (F.log((1 + F.col("m")) / (1 + F.col("df"))) + 1).alias("idf")
    kept = df.filter((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df) * F.col("m"))).select("word", idf, spot)
    words = staged_table(with_position(kept, "order"), "vocabulary").select("word", F.col("position").alias("at"), "idf")
    # words in too many posts, which count nowhere, get -1, so that they leave their rows as well
    none = df.filter(F.col("df") > F.lit(max_df) * F.col("m")).orderBy(F.desc("df"), "word").limit(often)
    none = none.select("word", F.lit(-1).cast("long").alias("at"), F.lit(0.0).alias("idf"))
    table = words.filter(F.col("at") < often).unionByName(none).toArrow().combine_chunks()  # at most twice ``often`` words
    found = [table.column(c).to_numpy() for c in ("at", "idf")]
    known = table.column("word").combine_chunks().cast(pa.string())
    known = known if isinstance(known, pa.Array) else pa.concat_arrays(known.chunks)
    # the last entry, which -1 finds, stands for all words that are not known
    shared = posts.sparkSession.sparkContext.broadcast((known, np.append(found[0], -2), np.append(found[1], 0.0)))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, numbers, weights = shared.value
        for batch in batches:
            lists = batch.column("counts")
            word, n = lists.flatten().flatten()
            owner = np.repeat(np.arange(batch.num_rows), _lengths(lists))
            row = pc.index_in(word, value_set=names).fill_null(-1).to_numpy(zero_copy_only=False)
            at = numbers[row]
            here, rest = np.flatnonzero(at >= 0), np.flatnonzero(at == -2)
            of = [np.bincount(owner[x], minlength=batch.num_rows) for x in (here, rest)]
            w = n.to_numpy(zero_copy_only=False)[here] * weights[row[here]]
            left = pa.StructArray.from_arrays([v.take(pa.array(rest)) for v in (word, n)], names=["word", "n"])
            parts = [batch.column("id"), _listed(of[0], pa.array(at[here], pa.int64())), _listed(of[0], pa.array(w, pa.float64())), _listed(of[1], left)]
            yield pa.RecordBatch.from_arrays(parts, ["id", "at", "w", "rest"])

    kind = posts.schema["id"].dataType.simpleString()
    halves = lists.mapInArrow(look_up, f"id {kind}, at array<long>, w array<double>, rest array<struct<word:string,n:long>>")
    cold = words.filter(F.col("at") >= often)
    if cold.isEmpty():
        whole = halves.select("id", "at", "w", F.array().cast("array<struct<at:long,w:double>>").alias("more"))
    else:
        halves = staged_table(halves, "frequent-words")
        rest = halves.select("id", F.inline("rest")).join(cold, "word").select("id", F.struct("at", (F.col("n") * F.col("idf")).alias("w")).alias("p"))
        more = rest.groupBy(F.struct("id").alias("key")).agg(F.collect_list("p").alias("more"))
        whole = halves.withColumn("key", F.struct("id")).join(more, "key", "left").select("id", "at", "w", "more")
    return whole.mapInArrow(_scaled, f"id {kind}, at array<long>, w array<double>"), words.select("word", "at")


def top_terms(tfidf: DataFrame, labels: DataFrame, clusters: int = 10, terms: int = 10, words: DataFrame | None = None) -> DataFrame:
    """The heaviest words of the largest clusters' centroids; a word missing in a post counts as 0.

    ``tfidf`` holds rows (id, word, w), or lists (id, at, w) of the numbers in ``words`` and their weights; then a word is a number until it is summed up.
    """
    sizes = labels.groupBy("cluster_id").agg(F.count("*").alias("size"))
    largest = sizes.orderBy(F.desc("size"), "cluster_id").limit(clusters)
    members = labels.join(F.broadcast(largest), "cluster_id")  # ``clusters`` rows
    rows = tfidf.join(members, "id")
    if words is not None:
        rows = rows.select("cluster_id", "size", F.inline(F.arrays_zip(F.col("at").alias("word"), F.col("w"))))
    weights = rows.groupBy("cluster_id", "size", "word").agg(F.sum("w").alias("total"))
    mean = weights.withColumn("weight", F.col("total") / F.col("size"))
    if words is not None:
        mean = mean.withColumnRenamed("word", "at").join(words, "at")
    order = Window.partitionBy("cluster_id").orderBy(F.desc(F.round("weight", 9)), "word")
    ranked = mean.withColumn("rank", F.row_number().over(order).cast("long"))
    return ranked.filter(F.col("rank") <= terms).select("cluster_id", "size", "rank", "word", "weight")


def cluster_cohesion(posts: DataFrame, stop_words: tuple[str, ...] = STOP_WORDS) -> DataFrame:
    """Mean word overlap per cluster of more than one post: (cluster_id, score, size).

    A post scores the sum, over its distinct words, of the word's post count in the cluster, divided by the
    cluster's total of such counts. Summed over the posts, each word adds its count once per post that has
    it, so the total is the sum of squared counts: two aggregations, and no join back to the posts.
    """
    words = posts.select(
        "cluster_id", F.explode(F.array_distinct(plain_words(F.col("text"), stop_words))).alias("word")
    )
    counts = words.groupBy("cluster_id", "word").agg(F.count("*").alias("c"))
    overlap = counts.groupBy("cluster_id").agg(
        (F.sum(F.col("c") * F.col("c")) / F.sum("c")).alias("overlap")
    )
    sizes = posts.groupBy("cluster_id").agg(F.count("*").alias("size")).filter(F.col("size") > 1)
    return sizes.join(overlap, "cluster_id", "left").select(
        "cluster_id", (F.coalesce("overlap", F.lit(0.0)) / F.col("size")).alias("score"), "size"
    )


def top_cohesion(cohesion: DataFrame, duplicates: DataFrame, clusters: int) -> DataFrame:
    """The first quarter of ``clusters`` by score, with the number of duplicates per cluster."""
    ranked = cohesion.join(duplicates, "cluster_id", "left")
    ranked = ranked.withColumn("duplicates", F.coalesce("duplicates", F.lit(0).cast("long")))
    return ranked.orderBy(F.desc("score"), "cluster_id").limit(clusters // 4)


def hashtag_eval_rows(df: DataFrame, cluster: str, tag: str, order: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Adds ``wrong_within`` and ``wrong_cluster`` to every row that has a tag.

    ``wrong_within``: the tag is not the first tag of its cluster. ``wrong_cluster``: an earlier row of another
    cluster has the same tag. Both follow from the first row of each (tag, cluster), so the clusters and tags
    are never gathered or sorted as groups.
    """
    rows = df.select(F.col(cluster).alias("c"), F.col(tag).alias("t"), F.col(order).alias("o"))
    rows = rows.filter(F.col("t").isNotNull() & (F.col("t") != ""))
    firsts = rows.groupBy("t", "c").agg(F.min("o").alias("o"), F.count("*").alias("n"))
    of_cluster = firsts.groupBy("c").agg(F.min_by("t", "o").alias("first_tag"), F.sum("n").alias("n"))
    earliest = firsts.groupBy("t").agg(F.min_by("c", "o").alias("c1"), F.min("o").alias("o1"), F.sum("n").alias("n"))
    second = firsts.join(earliest.select("t", "c1"), "t").filter(F.col("c") != F.col("c1"))
    second = second.groupBy("t").agg(F.min("o").alias("o2"))
    of_tag = earliest.join(second, "t", "left")
    marked = join_per_key(rows, of_cluster, "c", "n", "o", hot_rows)
    marked = join_per_key(marked, of_tag, "t", "n", "o", hot_rows)
    other = F.when(F.col("c") == F.col("c1"), F.col("o2")).otherwise(F.col("o1"))
    return marked.select(
        F.col("c").alias(cluster),
        F.col("t").alias(tag),
        F.col("o").alias(order),
        (F.col("t") != F.col("first_tag")).alias("wrong_within"),
        F.coalesce(other < F.col("o"), F.lit(False)).alias("wrong_cluster"),
    )


def hashtag_eval(df: DataFrame, cluster: str, tag: str, order: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row: (within, cross, empty). 0 tagged rows give null ratios."""
    marked = hashtag_eval_rows(df, cluster, tag, order, hot_rows)
    n = F.count("*")
    result = marked.agg(
        F.try_divide(F.count_if("wrong_within"), n).alias("within"),
        F.try_divide(F.count_if("wrong_cluster"), n * n).alias("cross"),
    )
    empty = df.agg(F.count_if(F.col(tag).isNull() | (F.col(tag) == "")).alias("empty"))
    return result.withColumn("empty", empty.scalar())


def mention_counts(posts: DataFrame) -> DataFrame:
    """(user_name, mentions) from the posts' mention lists."""
    names = posts.select(F.explode("mentions").alias("user_name"))
    return names.groupBy("user_name").agg(F.count("*").alias("mentions"))


def top_mentions(counts: DataFrame, k: int) -> DataFrame:
    return counts.orderBy(F.desc("mentions"), "user_name").limit(k)


def author_reach(counts: DataFrame, posts: DataFrame) -> DataFrame:
    """Mention counts with the followers of the user, as far as the user has posted."""
    users = posts.groupBy("user_name").agg(F.max("followers_count").alias("followers_count"))
    return counts.join(users, "user_name", "left")
