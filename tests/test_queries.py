import duckdb
import pytest

from quarry.plans import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS FROM '{sf}/{t}.parquet'")
    expected = con.sql(ORACLES[name])
    df = QUERIES[name](spark, sf)
    assert sorted(df.columns) == sorted(expected.columns)
    assert canonical(df.collect(), df.columns) == canonical(expected.fetchall(), expected.columns)
