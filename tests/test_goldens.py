"""Known numbers of the fixture views at sf0.01."""

import pytest
from pyspark.sql import functions as F

from snapdelta.operators.delta import counter_increase
from snapdelta.plans import databases, indexes, sessions, settings, tables
from snapdelta.registry.fixtures import view

SF_DIR = "/root/testdata/sf0.01"
KEYS = ["username", "queryid", "query"]


@pytest.fixture(scope="module")
def fixture(spark):
    return lambda name: view(spark, SF_DIR, name)


def test_statements(fixture):
    grown = counter_increase(fixture("fx_statements"), ["shared_blks_read", "calls"], KEYS, nullable=())
    grown = grown.cache()
    assert grown.count() == 750
    own = {
        r["query"]: (r["increase_shared_blks_read"], r["increase_calls"], r["elapsed_seconds"])
        for r in grown.where("username = 'user_0' and queryid = 0").collect()
    }
    grown.unpersist()
    assert own["click"] == (545, 11, 2_505_600)
    assert own["error"] == (593, 10, 2_332_800)


def test_databases(fixture):
    io = databases.database_increase(fixture("fx_database"), scope=())
    assert io.count() == 24
    grown = counter_increase(fixture("fx_database"), ["blks_read"], ["datname", "datid"], nullable=())
    assert grown.agg(F.sum("increase_blks_read")).first()[0] == 14_818


def test_unused_indexes(fixture):
    unused = indexes.unused_indexes(fixture("fx_indexes"))
    counted = {r["table_name"]: r["unused_indexes"] for r in indexes.unused_index_tables(unused, 100).collect()}
    assert len(counted) == 24
    assert all(count > 0 for count in counted.values())


def test_settings_waits_tables_checkpoints(fixture):
    assert settings.settings_first_seen(fixture("fx_settings")).count() == 118
    waits = sessions.wait_events(fixture("fx_activity"), scope=()).collect()
    assert len(waits) == 5
    assert {r["wait_event"]: r["total_samples"] for r in waits}["CPU"] == 1_982
    own = tables.table_activity(fixture("fx_tables"), families=[]).where(~F.expr("schemaname ilike '%pg_toast%'"))
    assert own.count() == 90
    counters = ["checkpoints_timed", "checkpoints_req"]
    grown = counter_increase(fixture("fx_bgwriter"), counters, ["host", "stats_reset"], nullable=())
    assert tuple(grown.agg(*[F.sum(f"increase_{c}") for c in counters]).first()) == (3_325, 1_693)
