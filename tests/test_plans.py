"""What the physical plans must and must not hold."""

import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
WRITING = {"lake_round_trip", "lake_time_window", "lake_csv_round_trip", "lake_compacted", "lake_folded", "written_report"}
WRITING |= {"lake_statements_round_trip", "lake_extra_columns", "lake_compacted_twice", "written_report_all", "lake_day_window", "lake_views", "lake_clustered_base", "lake_clustered_deltas"}
STREAMING = {"stream_folded_ingest", "stream_wait_counts", "stream_ingest", "stream_delta", "stream_wait_windows"}
# The corpus operators have tests of their own; some need Python, and most keep tables.
QUERIES = {n: q for n, q in contract.queries().items() if n not in WRITING | STREAMING and not n.startswith(("op", "pipeline"))}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def shuffled(spark):
    """Plans as they are when nothing is small enough to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_forced_broadcasts_or_row_functions(shuffled, name):
    text = plan(QUERIES[name](shuffled, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastHashJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in text
    assert "Exchange SinglePartition" not in text or name in ONE_ROW_RESULTS


# A global aggregate: one partition receives one partial row from each task, or an id looked up by name.
ONE_ROW_RESULTS = {
    "guard_one_engine",
    "database_io_named",
    "remainder_io_named",
    "vacuum_efficiency_fleet",
    "report_fleet_scope",
    "catalog_statement_stats_mixed",
    "catalog_statement_stats",
}


@pytest.mark.parametrize("name", ["counter_increase_telescoped"])
def test_increases_are_hash_aggregates(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "HashAggregate" in text and "SortAggregate" not in text and "ObjectHashAggregate" not in text
    assert "lag(" not in text


@pytest.mark.parametrize("name", ["sql_top_reads", "table_heap_reads", "index_hits", "unused_index_list"])
def test_top_lists_are_cut_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert text.count("WindowGroupLimit") == 2


def test_global_top_list_needs_no_sort_of_everything(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["sql_top_reads_fleet"](spark, SF_DIR))


def test_constraints_join_from_the_left(shuffled):
    assert "LeftOuter" in plan(QUERIES["catalog_index_stats"](shuffled, SF_DIR))


def test_settings_history_uses_a_semi_join(shuffled):
    assert "LeftSemi" in plan(QUERIES["settings_first_seen"](shuffled, SF_DIR))


def test_scans_read_only_needed_columns(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    scans = [line for line in plan(QUERIES["wait_event_types"](spark, SF_DIR)).splitlines() if "FileScan" in line]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert scans and all("ReadSchema: struct<user_id:bigint,event_type:string>" in line for line in scans)


FLAT = {
    "pg_stat_statements": "fx_statements",
    "pg_stat_database": "fx_database",
    "pg_stat_bgwriter": "fx_bgwriter",
    "table_stats": "fx_tables",
    "index_stats": "fx_indexes",
}


@pytest.fixture(scope="module")
def flat(shuffled, tmp_path_factory):
    """The fixtures as plain Parquet, so that a plan holds nothing but the operator."""
    from snapdelta.registry.fixtures import view

    root = tmp_path_factory.mktemp("flat")
    for stat, name in FLAT.items():
        view(shuffled, SF_DIR, name).write.parquet(str(root / stat))
    return {stat: shuffled.read.parquet(str(root / stat)) for stat in FLAT}


def _results(flat):
    from snapdelta.plans import bgwriter, databases, indexes, statements, tables
    from snapdelta.plans.deltas import stat_deltas

    rows = flat["pg_stat_database"]
    return {
        "deltas": stat_deltas(flat["pg_stat_statements"], "pg_stat_statements"),
        "roles": databases.role_change_points(rows),
        "shares": databases.database_increase(rows),
        "vacuum": tables.vacuum_efficiency(tables.table_activity(flat["table_stats"], families=[], nullable=())),
        "tables": tables.table_activity(flat["table_stats"], vacuum=False),
        "statements": statements.statement_base(flat["pg_stat_statements"]),
        "indexes": indexes.index_base(flat["index_stats"]),
        "background writer": bgwriter.bgwriter_summary(flat["pg_stat_bgwriter"]),
    }


@pytest.mark.parametrize("name", ["deltas", "roles", "tables", "statements", "indexes", "background writer"])
def test_one_scan_and_few_shuffles(flat, name):
    text = plan(_results(flat)[name])
    assert text.count("FileScan") == 1
    assert text.count("Exchange hashpartitioning") <= (3 if name == "background writer" else 2)
    assert "SortAggregate" not in text


@pytest.mark.parametrize("name", ["shares", "vacuum"])
def test_totals_combine_before_they_move(flat, name):
    """No window gathers a scope: what windows there are take differences within an entity."""
    windows = [line for line in plan(_results(flat)[name]).splitlines() if "Window [" in line]
    assert all("lag(" in line and "sum(" not in line for line in windows)


@pytest.mark.parametrize("name, fixture, most", [("sql_base", "fx_statements", 2), ("index_base", "fx_indexes", 2), ("table_base", "fx_tables", 2), ("bgwriter_summary", "fx_bgwriter", 3)])
def test_registered_increases_move_rows_once(shuffled, name, fixture, most):
    """One exchange of snapshot rows and one of what is left per entity and week, beyond those of the view itself."""
    from snapdelta.registry.fixtures import view

    exchanges = lambda df: plan(df).count("Exchange hashpartitioning")
    assert exchanges(QUERIES[name](shuffled, SF_DIR)) - exchanges(view(shuffled, SF_DIR, fixture)) <= most


def test_a_clustered_table_needs_no_exchange(shuffled, tmp_path):
    """Deltas and increases with gaps over a bucketed table, with a key beyond those it is bucketed by."""
    from snapdelta.plans.deltas import stat_deltas
    from snapdelta.plans.statements import statement_base
    from snapdelta.registry.fixtures import view
    from snapdelta.sources.clustered import cluster_snapshots, read_clustered

    cluster_snapshots(view(shuffled, SF_DIR, "fx_statements"), "clustered_plan", str(tmp_path / "t"), "pg_stat_statements", buckets=4)
    rows = read_clustered(shuffled, "clustered_plan", "pg_stat_statements")
    assert "Exchange" not in plan(statement_base(rows, duplicates=None, gaps="lag"))
    assert "Exchange" not in plan(stat_deltas(rows, "pg_stat_statements"))
