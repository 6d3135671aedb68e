"""Every query of the engine's own operators against its SQL, and the columns the entry module promises."""

import duckdb
import pytest

from lodestone import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def oracle(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    return f"{value:.6g}" if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_sql(spark, sf_dir, oracle, name):
    got = catalog.QUERIES[name](spark, sf_dir)
    want = oracle.execute(catalog.ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted(tuple(plain(r[c]) for c in columns) for r in got.collect()) == sorted(tuple(map(plain, r)) for r in want.fetchall())
