"""Driver contract: entry smoke run, query/oracle registry agreement."""

import duckdb

import __spark_entry__ as E
from streamledger.session import TABLES
from tests.conftest import SF_CHECK


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    assert df.columns == ["word", "n"]
    assert df.count() > 0


def _own():
    """Names of the library's own queries, whatever else is registered."""
    return set(E.QUERIES) | set(E.STREAM_QUERIES)


def test_every_query_has_an_oracle():
    assert _own() <= set(E.queries()) and _own() <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_oracles_parse_and_name_columns_like_queries(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_CHECK}/{t}.parquet'")
    q = E.queries()
    for name, sql in E.oracle_sql().items():
        if name not in _own():
            continue
        cols = [d[0] for d in con.execute(f"SELECT * FROM ({sql}) LIMIT 0").description]
        if name.endswith("_stream"):
            continue   # running these stages files; covered by test_streaming
        assert sorted(cols) == sorted(q[name](spark, SF_CHECK).columns), name


def test_small_parity_word_count(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_CHECK}/documents.parquet'")
    want = dict(con.execute(E.oracle_sql()["word_count"]).fetchall())
    got = dict(E.queries()["word_count"](spark, SF_CHECK).collect())
    assert got == want
