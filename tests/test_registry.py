"""Every registered query of the scoring analytics against its SQL."""

import duckdb
import pytest

from tesela.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "events documents labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(columns, dicts):
    return sorted(tuple((type(r[c]).__name__, repr(r[c])) for c in columns) for r in dicts)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    got = [r.asDict() for r in df.collect()]
    cur = duck.execute(registry.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    want = [dict(zip(names, r, strict=True)) for r in cur.fetchall()]
    assert sorted(names) == sorted(df.columns)
    assert rows(sorted(names), got) == rows(sorted(names), want)


def test_entry_and_names(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
