import importlib
import sys

import duckdb
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rows(df, columns):
    plain = df[columns].astype(object).where(df[columns].notna(), None)
    return sorted(tuple(map(str, r)) for r in plain.values.tolist())


@pytest.mark.parametrize("name", sorted(__spark_entry__.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    got, want = __spark_entry__.queries()[name](spark, SF).toPandas(), duck.execute(__spark_entry__.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns) and rows(got, columns) == rows(want, columns)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_imports_without_the_training_data_subpackage(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("evalspark.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "evalspark.llm", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    try:
        bare = importlib.reload(__spark_entry__)
        assert "activity_report" in bare.queries() and not any(n.startswith("op1") or n == "pipeline" for n in bare.queries())
    finally:
        monkeypatch.undo()
        importlib.reload(__spark_entry__)
