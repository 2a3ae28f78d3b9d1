"""Every query with SQL gives DuckDB's rows."""

import duckdb
import pytest

import quadrille.plans.catalog as catalog

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(round(r[i], 5) + 0.0 if isinstance(r[i], float) else r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    want = con.execute(catalog.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    got = catalog.QUERIES[name](spark, DIR)
    assert sorted(got.columns) == sorted(columns)
    assert normal(got.collect(), got.columns) == normal(want.fetchall(), columns)
