"""The registered queries on the smallest tables: columns and rows of the contract."""

import pytest

import __spark_entry__ as contract
from eventguard.llm.queries import queries

QUERIES = queries()
COLUMNS = {
    "op1_": {"doc_id", "n_pieces", "ids", "decoded_sha256"},
    "op2_": {"page_id", "url", "text", "n_chars"},
    "op3_": {"doc_id", "n_shingles", "component_id"},
    "op4_": {"doc_id", "item_id", "share", "changed_slots"},
    "op5_": {"doc_id", "n_lines", "removed"},
    "op6_": {"doc_id", "held_out", "lang_pred", "score"},
    "op7_": {"doc_id", "n_words", "n_removed", "kept_sha256"},
    "op8_": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op9_": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op10_": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op11_": {"doc_id", "n_features", "weight", "score", "rank"},
    "op12_": {"item_id", "rank", "doc_id", "score"},
    "op13_": {"query_id", "rank", "vec_id", "score"},
}


def test_register():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert [p for p in COLUMNS if sum(q.startswith(p) for q in QUERIES) != 1] == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_rows(spark, small, name):
    df = QUERIES[name](spark, small)
    assert COLUMNS[name.split("_")[0] + "_"] <= set(df.columns)
    rows, table = df.count(), "pages" if name.startswith("op2_") else "documents"
    total = spark.read.parquet(f"{small}/{table}.parquet").count()
    if name.startswith(("op12_", "op13_")):
        assert rows and rows % 20 == 0  # 20 for each item or query
    else:
        assert 0 < rows < total if name.startswith("op4_") else rows == total
