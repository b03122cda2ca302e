"""Registered queries: names, digest columns, and their SQL on the smallest tables."""

import pytest
from compare import connect, difference

import __spark_entry__ as driver
from policyscan.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_embedding_dedup": "vec_id n_links component_id kept",
    "op2_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op3_url_rules": "page_id host path rule verdict",
    "op6_toxicity": "doc_id held_out score predicted",
    "op7_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op8_mixing": "doc_id size source_size target taken",
    "op10_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op11_ranked_search": "item_id rank doc_id score",
    "op12_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op13_whitening": "vec_id component n deviation whitened explained identity_error",
}


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def test_all_are_registered():
    names = driver.queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, connection, name):
    assert difference(spark, connection, name, SF) is None


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_digest_columns(spark, name):
    frame = QUERIES[name](spark, SF)
    assert frame.columns[: len(COLUMNS[name].split())] == COLUMNS[name].split()
    assert dict(frame.dtypes).get("n_words", "bigint") == "bigint"
