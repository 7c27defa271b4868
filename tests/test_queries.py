"""Every core query with SQL gives what DuckDB gives."""

import duckdb
import pytest

from loomspan.plans import catalog, incremental, quotas, replay

DATA = "/root/testdata/sf0.001"
TABLES = "source_products external_pages catalog_drafts sitemap_entries work_items run_items runs events".split()
CASES = [(m, q) for m in (incremental, catalog, quotas, replay) for q in m.ORACLE]


@pytest.fixture(scope="session")
def duck():
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return db


@pytest.mark.parametrize("module, name", CASES, ids=[q for _, q in CASES])
def test_matches_sql(spark, duck, module, name):
    df = module.QUERIES[name](spark, DATA)
    mine = sorted(repr([r[c] for c in sorted(df.columns)]) for r in df.collect())
    result = duck.sql(module.ORACLE[name])
    order = [result.columns.index(c) for c in sorted(result.columns)]
    assert sorted(df.columns) == sorted(result.columns)
    assert mine == sorted(repr([row[i] for i in order]) for row in result.fetchall())


def test_every_row_is_decided(spark):
    """Sequential ledgers have no SQL; their decisions are tested against plain loops, here only that none is lost."""
    events = spark.read.parquet(f"{DATA}/events.parquet")
    batch, stream = quotas.QUERIES["q_admission"](spark, DATA), quotas.QUERIES["s_quota_stream"](spark, DATA)
    assert batch.count() == events.count() == stream.count()
    assert batch.filter("admitted").count() > 0 and stream.filter("admitted").count() > 0
    pool = replay.QUERIES["q_pool"](spark, DATA)
    assert pool.count() == events.filter("event_id % 20 <> 0").count() and {r["key"] for r in pool.select("key").distinct().collect()} >= {0, 1, 2}
