import duckdb
import pytest

import corpus_pipeline
from epispan.llm.queries import LLM_QUERIES, LLM_SQL

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(LLM_SQL))
def test_query_matches_its_statement(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = LLM_QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    result = con.execute(LLM_SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert sorted(repr([r[c] for c in columns]) for r in df.collect()) == sorted(repr([row[names.index(c)] for c in columns]) for row in result.fetchall())


COLUMNS = {
    "op1": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
    "op2": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op3": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op4": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op5": {"conv_id": "bigint", "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint", "loss_sha256": "string", "formatted_chars": "bigint"},
    "op6": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op7": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op8": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"},
    "op9": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op10": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op11": {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"},
    "op12": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op13": {
        "doc_id": "bigint", "n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint", "n_best": "bigint", "count_sum": "bigint",
        "groups_sha256": "string",
    },
}


@pytest.mark.parametrize("number", COLUMNS)
def test_contract_columns(spark, number):
    (name,) = (n for n in LLM_QUERIES if n.split("_")[0] == number)
    kinds = dict(LLM_QUERIES[name](spark, SF).dtypes)
    assert {c: kinds.get(c) for c in COLUMNS[number]} == COLUMNS[number]


def test_pipeline_is_registered():
    assert LLM_QUERIES["pipeline"] is corpus_pipeline.run and corpus_pipeline.ORACLE_SQL is None
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "language_id", "simhash_near_dedup", "benchmark_decontamination", "bpe_encoding"]
