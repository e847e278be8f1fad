"""Registered queries of the text operators: names, columns that their contracts fix, and SQL where it exists."""

from collections import Counter

import duckdb
import pytest

from tests.conftest import SF
from tslake.llm import queries

COLUMNS = {
    "op1_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op2_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op3_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op4_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op5_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op7_nearest_neighbours": ["query_id", "rank", "vec_id", "score"],
    "op8_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op11_lexical_search": ["item_id", "rank", "doc_id", "score"],
    "op12_topk_search": ["query_id", "rank", "vec_id", "score"],
    "op13_spelling_variants": ["word", "form", "root", "n", "n_near", "form_n"],
    "op9_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    assert queries.queries()[name](spark, SF).columns[: len(COLUMNS[name])] == COLUMNS[name]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, want = queries.queries()[name](spark, SF).toPandas(), c.execute(queries.oracle_sql()[name]).fetchdf()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert Counter(map(tuple, got[columns].astype(str).values)) == Counter(map(tuple, want[columns].astype(str).values))


def test_all_operators_and_the_pipeline():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [*[f"op{k}" for k in range(1, 14)], "pipeline"]
