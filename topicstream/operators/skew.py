"""Row positions and look-ups that hold when one key has a large share of all rows."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000


def join_per_key(
    rows: DataFrame, per_key: DataFrame, key: str, count: str, spread: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Inner join of ``rows`` with one row per key, safe for keys that hold many rows.

    ``per_key`` has a column ``count`` with the number of rows of the key. Keys above ``hot_rows`` are
    at most (all rows / hot_rows) many, so they are broadcast. Rows of these keys are then spread by
    the column ``spread``; all others meet their key in a shuffled join with at most ``hot_rows``
    rows a key.
    """
    values = [c for c in per_key.columns if c not in (key, count)]
    hot = per_key.filter(F.col(count) > hot_rows).select(key, F.struct(*values).alias("_hot"))
    cold = per_key.filter(F.col(count) <= hot_rows)
    cold = cold.select(key, F.lit(0).cast("long").alias("_salt"), F.struct(*values).alias("_cold"))
    marked = rows.join(F.broadcast(hot), key, "left").withColumn(
        "_salt",
        F.when(F.col("_hot").isNull(), F.lit(0).cast("long")).otherwise(
            F.pmod(F.xxhash64(spread), F.lit(4096)) + 1
        ),
    )
    joined = marked.join(cold, [key, "_salt"], "left").withColumn("_value", F.coalesce("_hot", "_cold"))
    return joined.filter(F.col("_value").isNotNull()).select(
        *rows.columns, *[F.col("_value")[v].alias(v) for v in values]
    )


def with_position(df: DataFrame, order: str, rows_per_range: int = 500_000, max_ranges: int = 10_000) -> DataFrame:
    """Adds ``position``, the 0-based rank by the unique numeric column ``order``.

    Ranges of ``order`` are ranked separately and shifted by the size of all earlier ranges, so no task
    sorts more than about one range. The limits of the ranges are plain numbers in the plan, so the result does
    not depend on how often or where a task runs.
    """
    total = df.count()
    ranges = min(max_ranges, -(-total // rows_per_range))
    if ranges > 1:
        steps = [n / ranges for n in range(1, ranges)]
        limits = df.agg(F.percentile_approx(order, steps, 10 * ranges)).head()[0]
        splits = [-math.inf, *sorted({float(x) for x in limits}), math.inf]
        ranged = Bucketizer(splits=splits, inputCol=order, outputCol="_range").transform(df)
    else:
        ranged = df.withColumn("_range", F.lit(0.0))
    # one row per range: at most ``max_ranges``
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("n"))
    shift = sizes.select("_range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_shift"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(order)) - 1
    ranked = ranged.withColumn("_inside", inside).join(F.broadcast(shift), "_range")
    return ranked.select(*df.columns, (F.col("_shift") + F.col("_inside")).cast("long").alias("position"))
