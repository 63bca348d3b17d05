import pytest
from oracle import connect, differences

from sluicegate.llm.queries import ENTRIES

SMALL = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op5_document_fingerprints": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op6_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op7_best_fit_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op8_byte_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op9_token_output": ["doc_id", "start", "n_tokens", "ids_crc32"],
}


@pytest.mark.parametrize("name", [name for name, entry in ENTRIES.items() if entry.sql])
def test_query_matches_its_sql(spark, name):
    assert differences(spark, connect(SMALL), name, ENTRIES[name].run, ENTRIES[name].sql, SMALL) is None


@pytest.mark.parametrize("name", COLUMNS)
def test_query_has_its_columns_and_every_document(spark, name):
    rows = ENTRIES[name].run(spark, SMALL)
    assert rows.columns == COLUMNS[name]
    wanted = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id").distinct().count()
    assert rows.select("doc_id").distinct().count() == wanted
