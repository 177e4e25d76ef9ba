"""Every query that has SQL against DuckDB, on the smallest tables."""

import duckdb
import pytest

from corpusmill.registry import ORACLES, QUERIES

DIR = "/root/testdata/sf0.001"


def shown(rows):
    return sorted(tuple("" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    want = con.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    got = QUERIES[name](spark, DIR)
    assert sorted(got.columns) == sorted(columns)
    assert shown(got.select(*columns).collect()) == shown(want.fetchall())


def test_rest_runs(spark):
    for name in set(QUERIES) - set(ORACLES) - {"q_spam_model", "q_topk_importance"}:
        assert QUERIES[name](spark, DIR).limit(5).collect() is not None
