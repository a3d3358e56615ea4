"""Driver contract and the SQL oracle at the smallest scale."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from oracle_compare import compare  # noqa: E402
from tonalyze.plans import catalog, oracle  # noqa: E402


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["prediccion", "total", "promedio_confianza"]
    assert sum(r.total for r in rows) == 200


def test_every_oracle_names_a_query():
    q, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(q)
    assert set(catalog.QUERIES) == set(oracle.statements())


def test_oracle_needs_no_installation_layout(tmp_path, monkeypatch):
    """The reference SQL is built without a jar, a session or pyspark's folder."""
    import pyspark
    before = oracle.statements()
    monkeypatch.setattr(pyspark, "__file__", str(tmp_path / "__init__.py"))
    assert oracle.statements() == before


def test_one_failing_statement_leaves_the_others(monkeypatch):
    def broken():
        raise RuntimeError("no")

    real = oracle.builders()
    monkeypatch.setattr(oracle, "builders", lambda: {**real, "lower_text": broken})
    assert set(oracle.statements()) == set(real) - {"lower_text"}


def test_stop_words_are_those_of_the_engine(spark):
    from pyspark.ml.feature import StopWordsRemover
    from tonalyze.stop_words import SPANISH
    assert list(SPANISH) == StopWordsRemover.loadDefaultStopWords("spanish")


@pytest.mark.parametrize("name", sorted(oracle.statements()))
def test_query_matches_oracle(spark, sf_small, name):
    rep = compare(spark, sf_small, [name], verbose=False)[name]
    assert rep["ok"], rep
