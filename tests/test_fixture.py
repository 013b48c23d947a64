"""The Spark charges view equals the DuckDB text of the same view, row for row."""

import duckdb

from eligo.sources.fixtures import CHARGES_SQL, load_charges
from tests.conftest import SF_SMALL


def test_charges_view_matches_sql(spark):
    got = sorted(tuple(r) for r in load_charges(spark, SF_SMALL).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM read_parquet('{SF_SMALL}/orders.parquet')")
    expected = sorted(con.execute(CHARGES_SQL).fetchall())
    assert len(got) == len(expected) == 1500
    assert got == expected
