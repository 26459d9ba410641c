"""The corpus queries against their SQL, and their contracts' columns."""

import pytest
from compare import database, difference

from kickflow.llm.oracles import ORACLES
from kickflow.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op2_repeated_strings": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op3_warc": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
    "op6_exact_duplicates": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
    "op7_byte_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op8_url_filter": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op10_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op11_periodic_runs": {"doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint", "exponent_milli": "bigint", "runs_sha256": "string", "collapsed_sha256": "string"},
    "op12_word_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op13_alignment": {"doc_id": "bigint", "n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint", "n_best": "bigint", "count_sum": "bigint", "groups_sha256": "string"},
}


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


@pytest.mark.parametrize("name", list(ORACLES))
def test_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), ORACLES[name], con) is None


@pytest.mark.parametrize("name", list(COLUMNS))
def test_columns(spark, name):
    found = dict(QUERIES[name](spark, SF_DIR).dtypes)
    assert {k: found.get(k) for k in COLUMNS[name]} == COLUMNS[name]
