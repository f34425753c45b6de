"""The registered queries, those with SQL against an independent engine on the smallest tables."""

import pytest

from checks.compare import difference, oracle_connection
from footfall.llm.queries import QUERIES
from footfall.llm.sql import ORACLES
from tests.conftest import SF

# What the contract names, query by query.
COLUMNS = {
    1: "page_id payload_bytes payload_digest record_type refers_to", 3: "doc_id held_out score predicted",
    2: "doc_id item_id", 4: "doc_id size source_size target taken", 5: "doc_id n_shingles component_id kept",
    6: "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    7: "doc_id n_email n_ip n_card n_phone base_sha256 spans", 8: "slot doc_ids",
    9: "doc_id held_out n_tokens n_known train_tokens base_score score", 10: "doc_id held_out lang_pred score",
    11: "doc_id held_out score predicted", 12: "lang rank phrase a l r n score",
    13: "anchor_id positive_id rank negative_id positive_score negative_score"}


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, oracle, name):
    ours = QUERIES[name](spark, SF).toPandas()
    assert len(ours) and difference(ours, oracle.execute(ORACLES[name]).df()) == ""


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns(spark, name):
    number = int(name[2:].split("_")[0])
    assert set(COLUMNS[number].split()) <= set(QUERIES[name](spark, SF).columns)
