"""Every query that has SQL gives the SQL's rows on the smallest tables."""

import math

import duckdb
import pytest

from mediaweave.queries import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(frame):
    def value(v):
        if v is None or isinstance(v, float) and math.isnan(v):
            return None
        return int(v) if isinstance(v, float) and v == int(v) else v

    names = sorted(frame.columns)
    return names, sorted(repr([value(v) for v in r]) for r in frame[names].astype(object).where(frame[names].notna(), None).values.tolist())


@pytest.fixture(scope="module")
def db(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, data, db, name):
    assert rows(QUERIES[name](spark, data).toPandas()) == rows(db.execute(ORACLE_SQL[name]).df())


def test_budget_is_kept(spark, data):
    out = QUERIES["context_budget"](spark, data).collect()
    assert out and all(r["token_count"] <= 512 for r in out)
