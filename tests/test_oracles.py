"""Every registered query with SQL gives DuckDB's rows on the smallest tables."""

from collections import Counter

import duckdb
import pandas as pd
import pytest

from tests.conftest import SF
from tslake.operators import grid, lookup
from tslake.plans import oracles, queries
from tslake.sources import stored

TABLES = "region nation customer supplier part orders lineitem events pages".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def rows(df):
    df = df[sorted(df.columns)].astype(object)
    return Counter(tuple(None if pd.isna(x) else float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x) for x in r) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query(spark, duck, name):
    got, want = queries.queries()[name](spark, SF).toPandas(), duck.execute(oracles.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_file_ids_are_version_5(spark):
    import uuid

    space = uuid.UUID("a1b2c3d4-e5f6-7890-abcd-ef1234567890")
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()}
    for r in queries.file_uuid(spark, SF).collect():
        assert r["file_uuid"] == str(uuid.uuid5(space, urls[r["page_id"]]))


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def broadcast_rows(spark, run):
    """What ``run`` gives, and the most rows that any of its joins has broadcast."""
    store, bus = spark._jsparkSession.sharedState().statusStore(), spark.sparkContext._jsc.sc().listenerBus()
    bus.waitUntilEmpty(30_000)
    known = {e.executionId() for e in (lambda s: [s.apply(i) for i in range(s.size())])(store.executionsList())}
    got, most = run(), 0
    bus.waitUntilEmpty(30_000)
    executions = store.executionsList()
    for at in {executions.apply(i).executionId() for i in range(executions.size())} - known:
        nodes, found = store.planGraph(at).allNodes(), store.executionMetrics(at)
        for node in (nodes.apply(i) for i in range(nodes.size())):
            for m in (node.metrics().apply(i) for i in range(node.metrics().size())) if node.name() == "BroadcastExchange" else ():
                if m.name() == "number of output rows" and found.contains(m.accumulatorId()):
                    most = max(most, int(found.apply(m.accumulatorId()).replace(",", "")))
    return got, most


@pytest.mark.parametrize(("name", "packed", "most"), [("jobs_gold_tables", False, 5), ("jobs_gold_tables", True, 9), ("gold_versions", False, 5), ("gold_versions", True, None)])
def test_jobs_broadcast_little(spark, duck, monkeypatch, name, packed, most):
    """Beyond the bounds jobs broadcast the mapping's few rows alone, though Spark would guess that these files are small; up to
    them ids go many in a row. There are 30 sheets or more."""
    monkeypatch.setattr(grid, "BROADCAST_COLUMNS", 0)
    monkeypatch.setattr(stored, "BROADCAST_KEYS", 0)
    if packed:
        monkeypatch.setattr(lookup, "PLAIN_IDS", 0)
    else:
        monkeypatch.setattr(stored, "BROADCAST_NUMBERS", 0)
        monkeypatch.setattr(lookup, "BROADCAST_IDS", 0)
    got, sent = broadcast_rows(spark, lambda: queries.queries()[name](spark, SF).toPandas())
    assert rows(got) == rows(duck.execute(oracles.oracle_sql()[name]).fetchdf())
    assert most is None or 0 < sent <= most
