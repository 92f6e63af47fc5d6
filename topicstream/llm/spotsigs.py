"""Document fingerprints by spot signatures, in DataFrame functions only.

A spot is a common word (anchor) with the chain of the next content words after it; other common words in between do not count. Each
spot is a 60-bit hash, a text's fingerprint is the sorted set of them. A text with words but no spot takes its words
instead, a text without words one hash of itself.

Fingerprints are compared by Jaccard similarity, pruned by set length: sets whose sizes differ by more than the threshold allows are never
compared, in ``links`` because they lie in length partitions that do not meet. ``links`` finds all similar pairs of a table
of fingerprints: equal sets are one representative, candidates share one of the rarest spots of a set, as many as a
similar set cannot miss altogether.

Defined results: null text is empty. Rows equal in doc_id and text are one document; every copy gets the same result. A null
id comes last. The document after the last one is the first, so an only document is its own next one. Extra
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicstream.session import staged_table

# Articles and forms of "to be" as anchors, further common words in four languages.
ANCHORS = (
    "the a an is was are be been der die das den dem des ein eine einen ist war sind le la les un une est sont el los las una es son fue"
).split()
COMMON = (
    "and of to in it for on that with as by this at from or not he she they we you his her and but und zu mit auf für nicht auch sich "
    "von im an er sie es wir et de du des que qui pour dans par sur pas en au aux avec il elle y no se con por para su al del lo como"
).split()
ANCHOR, CONTENT, END = "\x01", "\x02", "\n"
ROWS_PER_RANGE = 100_000


def hash60(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once, as the variable of a one-element array."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def spots(text: Column, chain: int = 2) -> Column:
    """Sorted distinct spot hashes of a text that is not null."""

    def unit_list(words: Column) -> Column:
        # a unit is a content word with the anchors since the content word before it
        marked = F.transform(
            words,
            lambda w: F.when(w.isin(ANCHORS), F.concat(F.lit(ANCHOR), w))
            .when(w.isin(COMMON), F.lit(""))
            .otherwise(F.concat(F.lit(CONTENT), w, F.lit(END))),
        )
        return F.split(F.array_join(marked, ""), END)

    def found(units: Column, content: Column) -> Column:
        def of_unit(unit: Column, k: Column) -> Column:
            following = F.concat_ws(":", *[F.get(content, k + i) for i in range(chain)])
            anchors = F.split(F.substring_index(unit, CONTENT, 1), ANCHOR)
            anchors = F.slice(anchors, 2, F.size(anchors))  # nothing stands before the first mark
            return F.transform(anchors, lambda a: F.concat(a, F.lit(":"), following))

        spotted = F.transform(units, lambda u, k: F.when(u.startswith(ANCHOR), of_unit(u, k)))
        return F.array_distinct(F.flatten(F.filter(spotted, lambda x: x.isNotNull())))

    def content_of(units: Column) -> Column:
        return F.transform(units, lambda u: F.substring_index(u, CONTENT, -1))

    def keys(words: Column) -> Column:
        # what follows the last content word has no chain
        units = bound(unit_list(words), lambda u: F.slice(u, 1, F.size(u) - 1))
        spotted = bound(units, lambda u: bound(content_of(u), lambda c: found(u, c)))
        return bound(spotted, lambda x: F.when(F.size(x) > 0, x).when(F.size(words) > 0, F.array_distinct(words)).otherwise(F.array(text)))

    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.array_sort(F.transform(bound(words, keys), hash60))


def jaccard(a: Column, b: Column, least: float = 0.0) -> Column:
    """Similarity of two sorted sets; 0 without a comparison if their sizes cannot reach ``least``."""
    value = bound(F.size(F.array_intersect(a, b)), lambda common: common / (F.size(a) + F.size(b) - common))
    if least <= 0:
        return value
    return F.when(F.least(F.size(a), F.size(b)) >= least * F.greatest(F.size(a), F.size(b)), value).otherwise(0.0)


def shown(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda x: x.cast("string")), " ")


def with_next(keys: DataFrame) -> DataFrame:
    """``keys`` (doc_id, hash) with next_id and next_hash in descending order of doc_id, the first one after the last.

    Ranges of ids are written, so their number and order hold; inside a range the next row is the following one, the last row's is the
    first row of the next range. Only one row per range is ever in one place.
    """
    order = [F.desc_nulls_last("doc_id"), F.asc("hash")]
    ranges = max(1, -(-keys.count() // ROWS_PER_RANGE))
    dealt = keys.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id())
    dealt = staged_table(dealt, "spots-order")
    here = Window.partitionBy("range").orderBy(*order)
    firsts = dealt.withColumn("place", F.row_number().over(here)).filter("place = 1")
    firsts = firsts.select("range", F.struct("doc_id", "hash").alias("first"))
    every = Window.orderBy("range")  # one row per range
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follow = F.coalesce(F.lead("first").over(every), F.first("first").over(whole)).alias("follow")
    rows = dealt.withColumn("inner", F.lead(F.struct("doc_id", "hash")).over(here))
    rows = rows.join(F.broadcast(firsts.select("range", follow)), "range").withColumn("n", F.coalesce("inner", "follow"))
    return rows.select("doc_id", "hash", "third", F.col("n.doc_id").alias("next_id"), F.col("n.hash").alias("next_hash"))


def compared(docs: DataFrame, chain: int = 2) -> DataFrame:
    """``docs`` (doc_id, text): every text's fingerprint against that of its edited form and of the next document."""
    text = F.coalesce("text", F.lit("")).alias("text")
    base = docs.select("doc_id", text, F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"))
    third = F.floor(F.length("text") / 3).cast("int").alias("third")
    order = staged_table(with_next(base.select("doc_id", "hash", third).distinct()), "spots-next")
    marked = base.withColumn("spots", spots(F.col("text"), chain))

    wanted = order.select(F.col("doc_id").alias("for_id"), F.col("hash").alias("for_hash"), "third", "next_id", "next_hash")
    supply = marked.join(wanted, marked.doc_id.eqNullSafe(wanted.next_id) & (marked.hash == wanted.next_hash))
    supply = supply.select("for_id", "for_hash", F.expr("substring(text, 1, third)").alias("head"), F.col("spots").alias("next_spots"))
    supply = supply.groupBy("for_id", "for_hash").agg(F.first("head").alias("head"), F.first("next_spots").alias("next_spots"))
    both = marked.join(supply, marked.doc_id.eqNullSafe(supply.for_id) & (marked.hash == supply.for_hash))

    n = F.length("text")
    edited = F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 3) as int))"), F.col("head"))
    both = both.select("doc_id", n.cast("long").alias("n_chars"), "spots", "next_spots", edited.alias("edited"))
    both = both.withColumn("edited_spots", spots(F.col("edited"), chain))
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        shown(F.col("spots")).alias("fingerprint"),
        shown(F.col("edited_spots")).alias("edited_fingerprint"),
        jaccard(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
        jaccard(F.col("spots"), F.col("next_spots")).alias("near_next"),
    )


def links(fingerprints: DataFrame, least: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """``fingerprints`` (doc_id, spots), ``least`` below 1: membership (doc_id, set_id) and similar pairs (a, b, similarity) of set ids, a < b.

    A set's length partition is the whole part of log(size) by 1 / least, so similar sets lie in the same or in
    neighbouring ones. A set is entered under its rarest spots, ``size - ceil(least * size) + 1`` of them: a similar set shares one.
    """
    set_id = F.md5(F.concat_ws(" ", F.transform("spots", lambda x: x.cast("string"))).cast("binary"))
    member = fingerprints.select("doc_id", set_id.alias("set_id"), "spots")
    sets = staged_table(member.groupBy("set_id").agg(F.first("spots").alias("spots")), "spots-sets")
    size = F.size("spots")
    rows = sets.select("set_id", size.alias("size"), F.explode("spots").alias("spot"))
    counts = rows.groupBy("spot").agg(F.count("*").alias("n"))
    ranked = rows.join(counts, "spot").groupBy("set_id", "size").agg(F.array_sort(F.collect_list(F.struct("n", "spot"))).alias("r"))
    kept = (F.col("size") - F.ceil(F.col("size") * least - 1e-9) + 1).cast("int")
    part = F.floor(F.log(F.col("size").cast("double")) / -math.log(least)).cast("int")
    entries = ranked.select("set_id", "size", part.alias("part"), F.explode(F.slice("r", F.lit(1), kept)).alias("e"))
    entries = entries.select("set_id", "size", "part", F.col("e.spot").alias("spot"))
    left = entries.select(F.col("set_id").alias("a"), F.col("size").alias("n"), "part", "spot")
    near = F.explode(F.array(F.col("part") - 1, F.col("part"), F.col("part") + 1)).alias("part")
    right = entries.select(F.col("set_id").alias("b"), F.col("size").alias("m"), near, "spot")
    fits = (F.col("a") < F.col("b")) & (F.least("n", "m") >= least * F.greatest("n", "m"))
    pairs = left.join(right, ["part", "spot"]).filter(fits).select("a", "b").distinct()
    found = pairs.join(sets.select(F.col("set_id").alias("a"), F.col("spots").alias("x")), "a")
    found = found.join(sets.select(F.col("set_id").alias("b"), F.col("spots").alias("y")), "b")
    found = found.select("a", "b", jaccard(F.col("x"), F.col("y"), least).alias("similarity")).filter(F.col("similarity") >= least)
    return member.select("doc_id", "set_id"), found
