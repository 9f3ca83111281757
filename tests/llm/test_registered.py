"""The registered queries of the subpackage at the smallest scale, with SQL where there is some."""

import pytest

from checks.compare import connect, difference
from tillwork.llm import registry

import corpus_pipeline

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_against_sql(spark, name):
    assert difference(registry.QUERIES[name](spark, SF), connect(SF), registry.ORACLE_SQL[name]) is None


def test_every_number_is_registered_once():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 14))


def test_pipeline_runs_its_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps, frame = [], docs
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, SF).cache()
        steps.append((name, frame.columns, frame.count()))
    assert [s[0] for s in steps] == ["toxicity", "language", "near-duplicates", "packing"]
    assert all(s[1] == docs.columns for s in steps[:-1])
    assert docs.count() >= steps[0][2] >= steps[1][2] > steps[2][2] > 0
    packed = corpus_pipeline.run(spark, SF)
    assert packed.count() == steps[3][2]
    assert packed.select("doc_id").distinct().count() == steps[2][2]
