"""Registered queries against their SQL counterparts at sf0.001.

A selection that touches every module runs by default; TOPICSTREAM_ALL=1 runs all of them.
"""

import os

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
SELECTION = (
    "read_terms slice_batches time_batches flatten_quotes project_post track_filter clean_tokens hash_bucket idf_weight "
    "collision_report tfidf_l2 predict cluster_quality best_url duplicate_groups propagate_labels hashtag_eval_rows top_cohesion "
    "top_terms add_clusters train_step merge_clusters dbscan history_grid write_assignments upsert_posts author_reach"
).split()
NAMES = sorted(entry.oracle_sql()) if os.environ.get("TOPICSTREAM_ALL") else SELECTION


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, db, name):
    count, problem = compare(spark, db, SF, entry.queries()[name], entry.oracle_sql()[name])
    assert problem is None
    assert count > 0


def test_every_counterpart_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    # the library's own queries; the optional ones have tests of their own
    without = set(entry.QUERIES) - set(entry.ORACLE)
    assert without == {"stem_english"}


def test_entry_runs(spark):
    rows = entry.entry(spark)
    assert rows.count() > 0 and "silhouette" in rows.columns
