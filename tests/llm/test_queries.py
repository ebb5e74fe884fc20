"""Every registered query with SQL against DuckDB, and the whole pipeline."""

import pytest

import corpus_pipeline as C
from paramo.llm import queries as Q
from tests.llm.helpers import MEDIUM, documents
from tests.oracle_check import duck, rows_of


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_oracle(spark, name):
    got, want = rows_of(Q.QUERIES[name](spark, MEDIUM).toPandas()), rows_of(duck(MEDIUM).execute(Q.ORACLES[name]).df())
    assert got == want


def test_pipeline_rows_follow_from_the_operators(spark):
    """Each stage's rows, recomputed from the operators' own results."""
    from paramo.llm import langid, mixing, simhash
    from paramo.llm.common import store

    docs = store(documents(spark), "test")
    kept = {r["doc_id"] for r in langid.predict_language(docs).where(f"lang_pred <> 'und' AND score >= {langid.MIN_MARGIN}").collect()}
    stages = dict(C.STAGES)
    assert list(stages) == ["language", "near_duplicates", "decontamination", "mixing", "sharding"]
    one = store(stages["language"](spark, docs, MEDIUM), "test")
    assert {r["doc_id"] for r in one.collect()} == kept and len(kept) > 0.98 * docs.count()
    groups = simhash.near_duplicates(one).collect()
    two = store(stages["near_duplicates"](spark, one, MEDIUM), "test")
    assert sorted(r["doc_id"] for r in two.collect()) == sorted({r["component_id"] for r in groups})
    three = store(stages["decontamination"](spark, two, MEDIUM), "test")
    before, after = ({r["doc_id"]: r for r in x.collect()} for x in (two, three))
    dirty = {r["doc_id"] for r in Q.decontam.contamination(two, spark.read.parquet(f"{MEDIUM}/benchmark.parquet")).where("n_hit > 0").collect()}
    assert set(before) - set(after) <= dirty
    assert all(after[i] == before[i] for i in after if i not in dirty) and all(after[i]["text"] != before[i]["text"] for i in after if i in dirty)
    four = store(stages["mixing"](spark, three, MEDIUM), "test")
    assert four.count() == sum(r["copies"] for r in mixing.mix_plan(three).collect())
    five = stages["sharding"](spark, four, MEDIUM)
    assert five.columns == [*docs.columns, "shard"] and five.count() == four.count()
    for x in (one, two, three, four):
        assert x.columns == docs.columns and x.schema == docs.schema
    run = C.run(spark, MEDIUM)
    assert sorted(map(str, run.collect())) == sorted(map(str, five.collect()))
