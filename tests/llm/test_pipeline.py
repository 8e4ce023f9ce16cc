import os

import corpus_pipeline
import pytest
from cases import AWKWARD, documents
from conftest import SF_SMALL

import __spark_entry__ as E
from wardline.checks.compare import check, duckdb_connection
from wardline.llm import decontaminate, packing, simhash, toxicity
from wardline.llm.queries import ORACLES, QUERIES, tokenizer_path
from wardline.llm.tables import read

pytestmark = pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="driver tables absent")


def test_every_operator_is_registered_once():
    names = sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    assert check(spark, name, SF_SMALL, QUERIES, ORACLES, duckdb_connection(SF_SMALL))["ok"]


def test_stages_take_effect_and_agree_with_their_operators(spark):
    docs = read(spark, SF_SMALL, "documents")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF_SMALL).cache()
        out[name] = {r[0] for r in docs.select("doc_id").collect()}
        ids = {r[0] for r in before.select("doc_id").collect()}
        if name != "packing":
            assert docs.columns == before.columns
        if name == "toxicity":
            said = toxicity.classify(before, read(spark, SF_SMALL, "labels")).where("predicted = 0").select("doc_id").collect()
            assert out[name] == {r[0] for r in said}
        elif name == "near_duplicates":
            said = simhash.near_duplicates(before).where("doc_id = component_id").select("doc_id").collect()
            assert out[name] == {r[0] for r in said}
        elif name == "decontamination":
            said = decontaminate.contaminated(before, read(spark, SF_SMALL, "benchmark")).select("doc_id").collect()
            assert out[name] == ids - {r[0] for r in said}
        else:
            assert out[name] == ids
    whole = packing.pack(before, tokenizer_path())
    cols = ["doc_id", "piece", "length", "ids_crc32"]
    assert sorted(map(tuple, whole.select(cols).collect())) == sorted(map(tuple, docs.select(cols).collect()))
    assert 0 < len(out["packing"]) < 200


def test_stages_take_awkward_rows_and_empty_tables(spark):
    for docs in (documents(spark, AWKWARD), documents(spark, AWKWARD).limit(0)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF_SMALL).cache()
            docs.count()
            if name != "packing":
                assert docs.columns == columns
