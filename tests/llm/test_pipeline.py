"""Registered queries against SQL, and the pipeline against its stages one by one."""

import pytest
from oracle_check import compare, connect
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from topicstream.llm import minhash
from topicstream.llm.oracle import ORACLE
from topicstream.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(llm, name):
    count, problem = compare(llm, connect(SF), SF, QUERIES[name], ORACLE[name])
    assert problem is None and count > 0


def test_thirteen_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names


def test_stages_keep_columns_and_decide(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit(1)).withColumn("_id", F.lit(2))
    odd = [(100_001, None), (100_002, "123"), (100_003, "")]
    extra = llm.createDataFrame(odd, "doc_id long, text string")
    docs = docs.unionByName(extra, allowMissingColumns=True)
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(stage(llm, kept[-1], SF).cache())
        assert kept[-1].columns == docs.columns, name
        assert kept[-1].exceptAll(kept[-2]).count() == 0
    first, second, third = (df.count() for df in kept[1:])
    assert docs.count() - 3 == first > second > third > 0
    # no two of the kept documents are linked
    again = minhash.near_duplicates(kept[3].select("doc_id", "text"))
    assert again.filter("not kept").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](llm, kept[3], SF)
    assert packed.select("doc_id").distinct().count() == third


def test_one_row_of_a_group_survives_repeated_and_null_ids(llm):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base)] * 3 + [(None, base)] * 2 + [(2, base + " more"), (2, "quite another text of its own"), (None, "and a lone one without id")]
    rows += [(None, "the same text twice without id")] * 2 + [(9, None)] * 2
    docs = llm.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, id_hash string")
    kept = corpus_pipeline.near_duplicate_stage(llm, docs, SF)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id or 0, r.text or "") for r in kept.collect())) == sorted([
        (1, base), (2, "quite another text of its own"), (0, "and a lone one without id"), (0, "the same text twice without id"), (9, "")
    ])


def test_pipeline_of_an_empty_table(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(llm, docs, SF)
    assert docs.count() == 0
