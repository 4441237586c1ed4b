"""Which queries have SQL; the others are compared with brute force or their libraries here."""

import __spark_entry__ as entry
from annualis.llm.oracle import ORACLE
from annualis.llm.queries import QUERIES

# Trained, tokenised, hashed or digested: no SQL says the same.
WITHOUT_SQL = {"op2_neighbour_quality", "op3_token_counts", "op4_quartile_digest", "op5_piece_codec", "op6_packing",
               "op8_pii", "op9_secrets", "op10_simhash", "pipeline"}


def test_queries_with_and_without_sql():
    assert set(QUERIES) | {"pipeline"} == set(ORACLE) | WITHOUT_SQL
    assert not set(ORACLE) & WITHOUT_SQL
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert len(QUERIES) == 13
