import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from topicstream.operators import quality as qu
from topicstream.plans import history as hi
from topicstream.plans import inputs as inp
from topicstream.plans.queries import QUERIES
from topicstream.schemas import MODEL
from topicstream.session import new_run_dir

ASSIGNED = "id long, cluster_id long, text string, urls array<string>, own double, other double"


def assigned(spark, rows):
    return spark.createDataFrame(rows, ASSIGNED)


def test_one_center_is_its_own_neighbor(spark):
    rows = spark.createDataFrame([(1, "a", [], [1.0, 2.0], 3.0), (2, "b", [], [0.0, 0.0], 0.0)],
                                 "id long, text string, urls array<string>, tfidf array<double>, vec_sum double")
    model = spark.createDataFrame([(4, [1.0, 1.0], 1.0)], MODEL)
    got = {r["id"]: r for r in qu.assign(rows, model).collect()}
    assert (got[1]["cluster_id"], got[1]["neighbor_id"]) == (4, 4)
    assert got[2]["cluster_id"] is None and got[2]["own"] is None
    score = qu.cluster_scores(qu.assign(rows, model)).collect()
    assert [(r["count"], r["silhouette"]) for r in score] == [(1, 0.0)]


@pytest.mark.parametrize("count, silhouette, expected",
                         [(7, 0.5, False), (8, 0.39, False), (8, 0.40, True), (8, 0.95, True), (8, 0.96, False)])
def test_interesting_bounds(spark, count, silhouette, expected):
    row = spark.createDataFrame([(count, silhouette)], "c long, s double")
    assert row.select(qu.interesting_flag(F.col("c"), F.col("s"))).head()[0] is expected


def test_report(spark):
    rows = assigned(spark, [
        (3, 1, "third", ["a", "b"], 0.5, 2.0), (2, 1, "second", ["a"], 0.5, 2.0), (1, 1, "first", [], 1.0, 2.0),
        (4, 2, "alone", [], 0.0, 0.0), (5, 3, "tie", ["a", "b"], 1.0, 0.5), (6, None, "none", ["z"], None, None)])
    got = {r["cluster_id"]: r for r in qu.cluster_quality(rows).collect()}
    assert sorted(got) == [1, 2, 3]
    assert (got[1]["rep_id"], got[1]["rep_text"], got[1]["best_url"], got[1]["count"]) == (2, "second", "a", 3)
    assert (got[1]["intra"], got[1]["inter"], got[1]["silhouette"]) == (0.67, 2.0, 0.67)
    assert (got[2]["best_url"], got[2]["silhouette"]) == ("none", 0.0)
    assert (got[3]["best_url"], got[3]["silhouette"]) == ("b", -0.5)
    summary = qu.batch_summary(qu.cluster_quality(rows)).head()
    assert (summary["posts"], summary["clusters"], summary["interesting"]) == (5, 3, 0)
    assert summary["avg_silhouette"] == pytest.approx((3 * 0.67 - 0.5) / 5)


def info(spark):
    rows = [(7, 1, 9, True), (9, 1, 3, False), (9, 2, 8, True), (7, 3, 4, False)]
    df = spark.createDataFrame(rows, "batch_id long, cluster_id long, count long, interesting boolean")
    for name, kind in (("silhouette", "double"), ("intra", "double"), ("inter", "double"), ("rep_id", "long"),
                       ("rep_text", "string"), ("best_url", "string")):
        df = df.withColumn(name, F.lit(None).cast(kind))
    return df


def test_history_grid(spark):
    grid = {(r["cluster_id"], r["batch_index"]): r["count"] for r in hi.history_grid(info(spark)).collect()}
    assert grid == {(1, 0): 9, (1, 1): 3, (2, 0): 0, (2, 1): 8}
    cells = {r["cluster_id"]: [c["count"] for c in r["cells"]] for r in hi.group_by_cluster(hi.history_grid(info(spark))).collect()}
    assert cells == {1: [9, 3], 2: [0, 8]}


def test_merges_are_sorted(spark):
    rows = hi.merge_cluster_info(info(spark)).collect()
    assert [(r["batch_id"], r["cluster_id"]) for r in rows] == [(7, 1), (7, 3), (9, 1), (9, 2)]


def test_drilldown(spark):
    rows = spark.createDataFrame([(7, 1, 10, "x"), (9, 1, 11, "y"), (9, 2, 12, "z")],
                                 "batch_id long, cluster_id long, id long, text string")
    assert [r["id"] for r in hi.drilldown(rows, 1, 1).collect()] == [11]


def test_event_history_with_cells_of_zeros(spark):
    """A cell whose values are all 0 has the silhouette of an IEEE division, as in the SQL, and fails no query."""
    folder = new_run_dir(spark, "events")
    week = dt.datetime(2024, 1, 2)
    rows = [(n, week, 1, "click", 1.0 + n % 2) for n in range(8)] + [(8, week + dt.timedelta(7), 1, "click", 0.0)]
    rows += [(9, week, 2, "view", 0.0), (10, week, 3, "view", -1.0), (11, week, 3, "view", 0.0)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double").write.parquet(f"{folder}/events.parquet")
    report = {(r["cluster_id"], r["batch_id"]): (r["silhouette"], r["interesting"]) for r in inp.event_report(spark, folder).collect()}
    assert report[19, 2] == (0.75, True)
    assert math.isnan(report[19, 5][0]) and math.isnan(report[28, 2][0]) and report[38, 2] == (-math.inf, False)
    assert not report[19, 5][1] and not report[28, 2][1]
    assert [(r["batch_index"], r["count"]) for r in QUERIES["history_grid"](spark, folder).orderBy("batch_index").collect()] == [(0, 8), (1, 1)]
    assert QUERIES["interesting_history"](spark, folder).count() == 2
    assert [r["cells"] for r in QUERIES["group_by_cluster"](spark, folder).collect()] == ["0:8 1:1"]
