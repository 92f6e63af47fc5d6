"""Raw API records: JSON text in, posts out.

Records are parsed once into VARIANT, because their keys differ from record to record. Lines that do not
parse are kept apart and never dropped silently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A record with one of these keys at the top level is a control message.
CONTROL_KEYS = ("delete", "status_withheld", "limit")
QUOTE_MARK = " @QUOTED: "


def read_raw_events(spark: SparkSession, path: str) -> DataFrame:
    """(raw, record): the line and its parsed form, which is null for a line that is not JSON."""
    return parse_raw(spark.read.text(path).withColumnRenamed("value", "raw"))


def parse_raw(lines: DataFrame) -> DataFrame:
    return lines.withColumn("record", F.try_parse_json("raw"))


def quarantined(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("record").isNull())


def drop_control_records(parsed: DataFrame) -> DataFrame:
    """Keep records without a control key at the top level; a key with a null value counts."""
    control = F.array(*[F.lit(k) for k in CONTROL_KEYS])
    is_control = F.arrays_overlap(F.json_object_keys("raw"), control)
    return parsed.filter(F.col("record").isNotNull() & ~F.coalesce(is_control, F.lit(False)))


def flatten_quotes(parsed: DataFrame) -> DataFrame:
    """Follow ``quoted_status``: id and time of the outer post, all texts in order, and user and entities
    of the innermost post. A post is dropped if any quoted post on the way is not English. Posts on the way without a text add none.

    Adds ``id``, ``text``, ``timestamp_ms``, ``level`` (the number of quotes followed), ``user`` and ``entities``. Every row is folded
    by itself, one level a step, as deep as it is nested: every level needs its key, so the number of times that the key is written bounds the
    steps; where a line holds escapes, which may spell the key otherwise, the number of opening braces does. Steps past the last quote change
    nothing. The plan is the same for any depth.
    """
    record = F.col("record")

    def quoted(post: Column) -> Column:
        inner = F.try_variant_get(post, "$.quoted_status", "variant")
        return F.when(~F.is_variant_null(inner), inner)  # a null value is no quote

    def step(state: Column, _: Column) -> Column:
        inner = quoted(state["post"])
        said = F.try_variant_get(inner, "$.text", "string")
        is_english = F.coalesce(F.try_variant_get(inner, "$.lang", "string") == "en", F.lit(False))
        deeper = F.struct(
            inner.alias("post"),
            F.coalesce(F.concat(state["text"], F.lit(QUOTE_MARK), said), state["text"], said).alias("text"),
            (state["level"] + 1).alias("level"),
            (state["english"] & is_english).alias("english"),
        )
        return F.when(inner.isNull(), state).otherwise(deeper)

    start = F.struct(
        record.alias("post"),
        F.try_variant_get(record, "$.text", "string").alias("text"),
        F.lit(0).alias("level"),
        F.lit(True).alias("english"),
    )
    braces = F.length("raw") - F.length(F.replace(F.col("raw"), F.lit("{"), F.lit("")))
    keys = F.length(F.replace(F.col("raw"), F.lit("quoted_status"), F.lit("quoted_status+"))) - F.length("raw")
    steps = F.when(F.contains("raw", F.lit("\\u")), braces).otherwise(keys)
    rows = parsed.withColumn("_flat", F.aggregate(F.array_repeat(F.lit(0), steps), start, step))
    return rows.filter("_flat.english").select(
        *parsed.columns,
        F.try_variant_get(record, "$.id", "bigint").alias("id"),
        F.col("_flat.text").alias("text"),
        F.try_variant_get(record, "$.timestamp_ms", "string").alias("timestamp_ms"),
        F.col("_flat.level").alias("level"),
        F.try_variant_get("_flat.post", "$.user", "variant").alias("user"),
        F.try_variant_get("_flat.post", "$.entities", "variant").alias("entities"),
    )


def own_entities(parsed: DataFrame) -> DataFrame:
    """Entity lists of the records themselves, whatever they quote."""
    return extract_entities(parsed.withColumn("entities", F.try_variant_get("record", "$.entities", "variant")))


def extract_entities(flat: DataFrame) -> DataFrame:
    """Adds ``hashtags``, ``urls`` and ``mentions``; null where a post has none."""

    def field(name: str, key: str) -> Column:
        items = F.try_variant_get("entities", f"$.{name}", f"array<struct<{key}:string>>")
        # an item without the key counts as an empty string
        values = F.transform(items, lambda x: F.coalesce(x[key], F.lit("")))
        return F.when(F.size(values) > 0, values)

    return (
        flat.withColumn("hashtags", field("hashtags", "text"))
        .withColumn("urls", field("urls", "expanded_url"))
        .withColumn("mentions", field("user_mentions", "screen_name"))
    )


def project_post(flat: DataFrame, *keep: str) -> DataFrame:
    """The nine collected fields and the columns to keep; entity lists are comma-joined as in the collected lines."""
    user = F.col("user")
    return flat.select(
        *keep,
        "id",
        "text",
        F.try_variant_get(user, "$.id", "bigint").alias("user_id"),
        F.try_variant_get(user, "$.screen_name", "string").alias("user_name"),
        F.try_variant_get(user, "$.followers_count", "bigint").alias("followers_count"),
        F.array_join("hashtags", ",").alias("hashtags"),
        F.array_join("urls", ",").alias("urls"),
        F.col("timestamp_ms").alias("timestamp"),
        F.array_join("mentions", ",").alias("user_mentions"),
    )


def collect_posts(parsed: DataFrame, *keep: str) -> DataFrame:
    """Raw records to collected lines: control filter, quotes, entities, projection."""
    return project_post(extract_entities(flatten_quotes(drop_control_records(parsed))), *keep)


def rejected(parsed: DataFrame) -> DataFrame:
    """Lines that cannot become posts, with the ``reason``; control records are no such lines."""
    nameless = drop_control_records(parsed).filter(F.try_variant_get("record", "$.id", "bigint").isNull())
    lines = quarantined(parsed).withColumn("reason", F.lit("not JSON"))
    return lines.unionByName(nameless.withColumn("reason", F.lit("no id"))).drop("record")


def first_per_id(rows: DataFrame, *order: str) -> DataFrame:
    """One row per id: the least by the ``order`` columns and then by all others, so the choice never depends on the layout."""
    rest = [c for c in rows.columns if c not in ("id", *order)]
    return rows.groupBy("id").agg(F.min(F.struct(*order, *rest)).alias("r")).select("id", *[f"r.{c}" for c in rows.columns if c != "id"])


def upsert_posts(new: DataFrame, arrival: str | tuple[str, ...], stored: DataFrame | None = None) -> DataFrame:
    """First row per id by the ``arrival`` columns, ties by content; ids that are stored already are ignored.

    The form for tables; a stream of files keeps the seen ids as state (``streaming/collect.py``).
    """
    if stored is not None:
        new = new.join(stored.select("id"), "id", "left_anti")
    return first_per_id(new, *([arrival] if isinstance(arrival, str) else arrival))
