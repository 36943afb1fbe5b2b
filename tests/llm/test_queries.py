"""The registered queries: their columns on the smallest driver tables, and those with SQL against it."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from parity import compare, connect  # noqa: E402

SF = "/root/testdata/sf0.001"

COLUMNS = {
    "op1_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op2_pack": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
                 "sequence_id": "bigint", "offset": "bigint"},
    "op3_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op4_secret_scan": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint",
                        "base_sha256": "string", "spans": "string"},
    "op5_substring_dedup": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op7_simhash_groups": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op9_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op11_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op12_trie": {"conv_id": "bigint", "depth": "bigint", "parent_conv_id": "bigint", "n_convs": "bigint", "n_children": "bigint",
                  "n_leaves": "bigint", "saved_tokens": "bigint", "ends_sha256": "string"},
    "op13_runs": {"doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint",
                  "exponent_milli": "bigint", "runs_sha256": "string", "collapsed_sha256": "string"},
    "op10_nearest": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    df = entry.queries()[name](spark, SF)
    assert dict(df.dtypes) == COLUMNS[name]
    n = {"op10_nearest": 50, "op12_trie": 20}.get(name, 200)
    assert df.count() >= n if name in ("op2_pack", "op12_trie") else df.count() == n


@pytest.mark.parametrize("name", sorted(entry.LLM_SQL))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, connect(SF), name, entry.queries()[name], entry.oracle_sql()[name], SF) is None
