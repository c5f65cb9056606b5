"""Which queries of the training-data operators have a SQL twin, and what covers the others."""

from __future__ import annotations

from pathlib import Path

import corpus_pipeline
from stayledger.llm import queries

HERE = Path(__file__).resolve().parent

#: Queries that SQL cannot express, and the module with their tests.
WITHOUT_TWIN = {
    "op1_license_scan": "test_text_operators.py",
    "op2_pii_patterns": "test_text_operators.py",
    "op3_latent_leaks": "test_text_operators.py",
    "op8_quality": "test_text_operators.py",
    "op9_spot_signatures": "test_text_operators.py",
    "op13_token_lexicon": "test_token_lexicon.py",
}


def test_every_query_has_a_twin_or_tests():
    registered, twins = set(queries.queries()), set(queries.oracle_sql())
    assert twins | set(WITHOUT_TWIN) == registered and not twins & set(WITHOUT_TWIN)
    assert all((HERE / name).exists() for name in WITHOUT_TWIN.values())
    assert corpus_pipeline.ORACLE_SQL is None and (HERE / "test_pipeline.py").exists()
