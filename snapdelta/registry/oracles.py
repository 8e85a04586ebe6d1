"""Plain SQL for each registered query, written from the definitions: increases as sums of lagged differences,
ratios in whole-number arithmetic."""

from __future__ import annotations

from snapdelta.registry.fixtures import view_sql

HD = "host, database"
STMT = "host, database, username, queryid, query"


def _with(*views: str) -> str:
    return "with " + ",\n".join(f"{v} as ({view_sql(v)})" for v in views)


def _ratio(reads: str, hits: str) -> str:
    asked = f"({reads} + {hits})"
    return (
        f"cast(case when {reads} = 0 then 100.0 when {asked} <> 0 then "
        f"((20000 * {hits} + {asked}) // (2 * {asked})) / 100.0 end as double)"
    )


def _rounded(total: str, units: str, factor: int = 1) -> str:
    """factor * total / units to two digits, for whole numbers from zero up."""
    d = f"(case when {units} = 0 then 1 else {units} end)"
    return f"cast((({200 * factor} * {total} + {d}) // (2 * {d})) / 100.0 as double)"


def _whole_percent(part: str, total: str) -> str:
    d = f"(case when {total} = 0 then 1 else {total} end)"
    return f"cast((200 * {part} + {d}) // (2 * {d}) as bigint)"


def _text(n: str) -> str:
    parts = []
    for power, unit in enumerate(["bytes", "KB", "MB", "GB", "TB", "PB", "EB"]):
        scaled = f"printf('%3.1f {unit}', cast({n} as double) / {float(1024**power)!r})"
        parts.append(f"when {n} < {float(1024 ** (power + 1))!r} then {scaled}")
    return "case " + " ".join(parts) + " end"


def _deltas(view: str, keys: str, counters: list[str], extra: str = "") -> str:
    """Rows of a view with d_<counter> and d_seconds."""
    columns = ", ".join(f"coalesce({c} - lag({c}) over k, 0) d_{c}" for c in counters)
    seconds = "coalesce(epoch(snapshot_time) - lag(epoch(snapshot_time)) over k, 0) d_seconds"
    return (
        f"select *, {columns}, {seconds} {extra} from {view} "
        f"window k as (partition by {keys} order by snapshot_time)"
    )


def _sums(counters: list[str]) -> str:
    return ", ".join(f"cast(sum(d_{c}) as bigint) {c}" for c in counters)


# --- delta engine ---------------------------------------------------------------------------------------------------

_GAPPY = (
    "g as (select * exclude (calls), case when not (queryid % 5 = 0 and day(snapshot_time) % 7 = 3) then calls end calls "
    "from fx_statements)"
)


def _delta_sql() -> dict[str, str]:
    three = ["calls", "shared_blks_read", "wal_bytes"]
    return {
        "counter_delta_lag": f"""{_with("fx_statements")}
select {STMT}, snapshot_time, {", ".join(f"d_{c} delta_{c}" for c in three)}
from ({_deltas("fx_statements", STMT, three)})""",
        "counter_delta_gaps": f"""{_with("fx_statements")}, {_GAPPY}
select {STMT}, snapshot_time, d_calls delta_calls from ({_deltas("g", STMT, ["calls"])})""",
        "counter_delta_restart": f"""{_with("fx_bgwriter")}, p as (
  select *, lag(checkpoints_timed) over k pt, lag(buffers_checkpoint) over k pb from fx_bgwriter
  window k as (partition by host, database order by snapshot_time))
select host, database, snapshot_time,
  coalesce(case when checkpoints_timed < pt then checkpoints_timed else checkpoints_timed - pt end, 0) delta_checkpoints_timed,
  coalesce(case when buffers_checkpoint < pb then buffers_checkpoint else buffers_checkpoint - pb end, 0)
    delta_buffers_checkpoint
from p""",
        "counter_delta_raw_resets": f"""{_with("fx_bgwriter")}
select host, database, snapshot_time, coalesce(lag(checkpoints_timed) over k, -1) previous,
  coalesce(checkpoints_timed - lag(checkpoints_timed) over k, 0) delta_checkpoints_timed
from fx_bgwriter window k as (partition by host, database order by snapshot_time)""",
        "counter_increase_telescoped": f"""{_with("fx_statements")}
select {STMT}, {", ".join(f"cast(sum(d_{c}) as bigint) increase_{c}" for c in three)},
  cast(sum(d_seconds) as double) elapsed_seconds
from ({_deltas("fx_statements", STMT, three)}) group by {STMT}""",
        "counter_increase_gaps": f"""{_with("fx_statements")}, {_GAPPY}
select {STMT}, cast(sum(d_calls) as bigint) increase_calls, cast(sum(d_shared_blks_read) as bigint) increase_shared_blks_read,
  cast(sum(d_seconds) as double) elapsed_seconds
from ({_deltas("g", STMT, ["calls", "shared_blks_read"])}) group by {STMT}""",
        "counter_increase_zero": f"""{_with("fx_bgwriter")}
select host, database, cast(sum(greatest(d_checkpoints_timed, 0)) as bigint) increase_checkpoints_timed,
  cast(sum(greatest(d_buffers_checkpoint, 0)) as bigint) increase_buffers_checkpoint,
  cast(sum(d_seconds) as double) elapsed_seconds
from ({_deltas("fx_bgwriter", HD, ["checkpoints_timed", "buffers_checkpoint"])}) group by host, database""",
        "elapsed_seconds": f"""{_with("fx_statements")}
select {STMT}, snapshot_time, epoch(snapshot_time) epoch, cast(d_seconds as double) delta_seconds
from ({_deltas("fx_statements", STMT, ["calls"])})""",
        "fold_duplicate_rows": f"""{_with("raw_statements")}
select userid, dbid, snapshot_time, cast(sum(calls) as bigint) calls, cast(sum(shared_blks_read) as bigint) shared_blks_read
from raw_statements group by userid, dbid, snapshot_time""",
        "increase_of_folded_rows": f"""{_with("fx_statements")}, f as (
  select host, database, query, snapshot_time, sum(calls) calls, sum(shared_blks_read) shared_blks_read
  from fx_statements group by host, database, query, snapshot_time)
select host, database, query, cast(sum(d_calls) as bigint) increase_calls,
  cast(sum(d_shared_blks_read) as bigint) increase_shared_blks_read, cast(sum(d_seconds) as double) elapsed_seconds
from ({_deltas("f", "host, database, query", ["calls", "shared_blks_read"])}) group by host, database, query""",
    }


def _policy_change(c: str, policy: str, same: str = "true") -> str:
    """One interval's part of an increase, by the definition of each reset policy; nothing where either value is null."""
    anew = c if policy == "restart" else "0"
    fell = f"when {c} < p_{c} then {anew}" if policy != "raw" else ""
    return f"coalesce(case when rn = 1 then 0 when not ({same}) then {anew} {fell} else {c} - p_{c} end, 0)"


def _policy_increase(fixture: str, keys: str, counters: list[str], policy: str, mark: str | None = None, extra: str = "") -> str:
    lags = ", ".join(f"lag({c}) over k p_{c}" for c in [*counters, *([mark] if mark else [])])
    same = f"{mark} is not distinct from p_{mark}" if mark else "true"
    sums = ", ".join(f"cast(sum({_policy_change(c, policy, same)}) as bigint) increase_{c}" for c in counters)
    return f"""{_with(fixture)}{extra}, d as (
  select *, {lags}, row_number() over k rn from {"lived" if extra else fixture} window k as (partition by {keys} order by snapshot_time))
select {keys}, {sums}, cast(epoch(max(snapshot_time)) - epoch(min(snapshot_time)) as double) elapsed_seconds from d group by {keys}"""


TABLE = "host, database, schemaname, relname"


def _summary_sql() -> dict[str, str]:
    two, bgwriter = ["heap_blks_read", "idx_blks_read"], ["checkpoints_timed", "buffers_checkpoint"]
    policies = ("raw", "zero", "restart")
    lived = f""", r as ({view_sql("fx_bgwriter")}), lived as (
  select *, (select max(r.stats_reset) from r where r.host <> 'h1' and r.host = s.host and r.database = s.database and r.stats_reset <= s.snapshot_time) since
  from fx_statements s)"""
    return {
        **{f"summaries_increase_{p}": _policy_increase("fx_bgwriter", HD, bgwriter, p) for p in policies},
        "summaries_increase_gaps": _policy_increase("fx_statements_gaps", STMT, ["calls", "shared_blks_read", "wal_bytes"], "raw"),
        **{f"table_increase_lives_{p}": _policy_increase("fx_tables_lives", TABLE, two, p, "relid") for p in policies},
        "statement_increase_since_reset": _policy_increase("fx_statements", STMT, ["calls", "shared_blks_read"], "raw", "since", lived),
        "table_delta_lives": f"""{_with("fx_tables_lives")}, d as (
  select *, lag(heap_blks_read) over k p_heap_blks_read, lag(relid) over k p_relid, row_number() over k rn
  from fx_tables_lives window k as (partition by {TABLE} order by snapshot_time))
select {TABLE}, snapshot_time, cast({_policy_change("heap_blks_read", "raw", "relid is not distinct from p_relid")} as bigint) delta_heap_blks_read from d""",
        "table_lifetimes": f"""{_with("fx_tables_lives")}, n as (
  select *, case when relid is not distinct from lag(relid) over k and row_number() over k > 1 then 0 else 1 end began
  from fx_tables_lives window k as (partition by {TABLE} order by snapshot_time)),
l as (select *, cast(sum(began) over (partition by {TABLE} order by snapshot_time) as bigint) life from n)
select {TABLE}, life, any_value(relid) relid, min(snapshot_time) first_time, max(snapshot_time) last_time, count(*) snapshots
from l group by {TABLE}, life""",
        "lake_day_window": f"{_statement_base('fx_statements_window')} select * from t",
    }


def _all_deltas(fixture: str, by: str, counters: str) -> str:
    names = counters.split()
    return f"""{_with(fixture)}
select {HD}, {by}, snapshot_time, {", ".join(f"d_{c} delta_{c}" for c in names)}
from ({_deltas(fixture, f"{HD}, {by}", names)})"""


def _stat_delta_sql() -> dict[str, str]:
    blocks = " ".join(f"{s}_blks_{k}" for s in ("heap", "idx", "toast", "tidx") for k in ("read", "hit"))
    return {
        "statement_deltas": _all_deltas("fx_statements", "username, queryid, query", " ".join(_STMT_COUNTERS)),
        "table_deltas": _all_deltas(
            "fx_tables", "schemaname, relname", f"{blocks} vacuum_count autovacuum_count n_live_tup n_dead_tup"
        ),
        "index_deltas": _all_deltas("fx_indexes", "schemaname, relname, indexrelname", "idx_blks_read idx_blks_hit"),
        "database_deltas": _all_deltas("fx_database", "datname, datid", "blks_read blks_hit"),
        "bgwriter_deltas": _all_deltas(
            "fx_bgwriter",
            "stats_reset",
            "checkpoints_timed checkpoints_req buffers_checkpoint buffers_clean buffers_backend",
        ),
    }


# --- statements -----------------------------------------------------------------------------------------------------

_STMT_COUNTERS = (
    "calls total_exec_time shared_blks_read shared_blks_hit shared_blks_written temp_blks_read temp_blks_written "
    "blk_read_time wal_records wal_fpi wal_bytes"
).split()
_STMT_SIZES = {
    "shared_written": "shared_blks_written",
    "shared_read": "shared_blks_read",
    "shared_hit": "shared_blks_hit",
    "temp_read": "temp_blks_read",
    "temp_written": "temp_blks_written",
}


def _statement_base(fixture: str = "fx_statements") -> str:
    sizes = ", ".join(f"8192 * {c} {name}_bytes" for name, c in _STMT_SIZES.items())
    moved = " or ".join(f"{c} > 0" for c in _STMT_SIZES.values())
    return f"""{_with(fixture)}, inc as (
  select {STMT}, {_sums(_STMT_COUNTERS)}, cast(sum(d_seconds) as bigint) span
  from ({_deltas(fixture, STMT, _STMT_COUNTERS)}) group by {STMT}),
b as (select {STMT}, {sizes}, {_ratio("shared_blks_read", "shared_blks_hit")} hit_ratio, calls,
  {_rounded("total_exec_time", "calls")} ms_per_call, {_rounded("shared_blks_hit", "calls")} shared_hit_per_call,
  {_rounded("shared_blks_read", "calls")} shared_read_per_call, {_rounded("blk_read_time", "calls")} read_ms_per_call,
  {_rounded("calls", "span")} calls_per_second, wal_records, wal_fpi, wal_bytes
  from inc where {moved}),
t as (select *, {", ".join(f"{_text(name + '_bytes')} {name}_text" for name in [*_STMT_SIZES, "wal"])} from b)"""


def _top_statements(metric: str, k: int, positive: bool = True) -> str:
    return f"""{_statement_base()}
select * from (select *, cast(row_number() over (partition by host, database order by {metric} desc, username, queryid, query)
  as integer) rank from t {f"where {metric} > 0" if positive else ""}) where rank <= {k}"""


def _statement_sql() -> dict[str, str]:
    return {
        "sql_base": f"{_statement_base()} select * from t",
        "sql_base_digest": f"{_statement_base()} select * from t",
        "sql_base_gaps": f"{_statement_base('fx_statements_gaps')} select * from t",
        "sql_base_missing_column": f"{_statement_base('fx_statements_missing')} select * from t",
        "lake_compacted_twice": f"{_statement_base()} select * from t",
        "sql_top_reads": _top_statements("shared_read_bytes", 10),
        "sql_top_hits": _top_statements("shared_hit_bytes", 10),
        "sql_top_writes": _top_statements("shared_written_bytes", 10),
        "sql_top_temp_reads": _top_statements("temp_read_bytes", 10),
        "sql_top_temp_writes": _top_statements("temp_written_bytes", 10),
        "sql_top_wal": _top_statements("wal_bytes", 10),
        "sql_top5_io": _top_statements("shared_read_bytes", 5, positive=False),
        "sql_top_reads_fleet": f"""{_statement_base()}
select * from t where shared_read_bytes > 0 order by shared_read_bytes desc, username, queryid, query limit 50""",
    }


# --- tables ---------------------------------------------------------------------------------------------------------

_FAMILIES = {"heap": "heap", "index": "idx", "toast": "toast", "toast_index": "tidx"}


def _table_cte(keys: str) -> str:
    counters = [f"{s}_blks_{k}" for s in _FAMILIES.values() for k in ("read", "hit")] + ["vacuum_count", "autovacuum_count"]
    asked = "(n_dead_tup + n_live_tup)"
    hundredths = (
        f"case when n_dead_tup = 0 then 0 when {asked} <> 0 then (20000 * n_dead_tup + {asked}) // (2 * {asked}) end"
    )
    return f"""{_with("fx_tables")}, inc as (
  select {keys}, concat(schemaname, '.', relname) table_name, {_sums(counters)},
    cast(sum(n_dead_tup) // count(n_dead_tup) as bigint) average_dead_rows,
    cast(sum(ratio) // (100 * count(ratio)) as bigint) dead_row_ratio
  from ({_deltas("fx_tables", keys, counters, f", {hundredths} ratio")}) group by {keys})"""


def _table_base() -> str:
    sizes = ", ".join(f"8192 * {s}_blks_{k} {f}_{k}_bytes" for f, s in _FAMILIES.items() for k in ("read", "hit"))
    ratios = ", ".join(f"{_ratio(f'{s}_blks_read', f'{s}_blks_hit')} {f}_hit_ratio" for f, s in _FAMILIES.items())
    moved = " or ".join(f"{s}_blks_{k} > 0" for s in _FAMILIES.values() for k in ("read", "hit"))
    texts = ", ".join(f"{_text(f'{f}_{k}_bytes')} {f}_{k}_text" for f in _FAMILIES for k in ("read", "hit"))
    return f"""{_table_cte("host, database, schemaname, relname")},
b as (select {HD}, table_name, {sizes}, {ratios} from inc where {moved}),
t as (select *, {texts} from b)"""


def _top_table(family: str, kind: str) -> str:
    metric = f"{family}_{kind}_bytes"
    return f"""{_table_base()}
select * from (select {HD}, table_name, {metric}, {family}_hit_ratio, {family}_{kind}_text,
  cast(row_number() over (partition by host, database order by {metric} desc, table_name) as integer) rank
  from t where {metric} > 0) where rank <= 10"""


def _vacuum(scope: str) -> str:
    keys = ", ".join(filter(None, [scope, "schemaname", "relname"]))
    total = f"over ({f'partition by {scope}' if scope else ''})"
    return f"""{_table_cte(keys)}, s as (
  select *, sum(vacuum_count) {total} m, sum(autovacuum_count) {total} a from inc)
select {scope + ',' if scope else ''} table_name, cast(m + a as bigint) total_vacuums, vacuum_count manual_vacuums,
  {_whole_percent("vacuum_count", "m")} manual_vacuum_percent, autovacuum_count autovacuums,
  {_whole_percent("autovacuum_count", "a")} autovacuum_percent, average_dead_rows, dead_row_ratio
from s where schemaname not ilike '%pg_toast%' and (vacuum_count > 0 or autovacuum_count > 0)"""


def _table_sql() -> dict[str, str]:
    low = " or ".join(f"count(*) filter (where {f}_hit_ratio < 99) > 1" for f in _FAMILIES)
    return {
        "table_base": f"{_table_base()} select * from t",
        **{f"table_{f}_{k}s": _top_table(f, k) for f in _FAMILIES for k in ("read", "hit")},
        "vacuum_efficiency": _vacuum(HD),
        "vacuum_efficiency_fleet": _vacuum(""),
        "table_findings": f"""{_table_base()}
select {HD}, 'table' category, 'Several tables have a low cache-hit ratio; see the table I/O lists.' recommendation
from b group by {HD} having {low}""",
    }


# --- indexes --------------------------------------------------------------------------------------------------------


def _index_base(fixture: str = "fx_indexes") -> str:
    keys = "host, database, schemaname, relname, indexrelname"
    counters = ["idx_blks_read", "idx_blks_hit"]
    return f"""{_with(fixture)}, inc as (
  select {keys}, {_sums(counters)} from ({_deltas(fixture, keys, counters)}) group by {keys}),
b as (select {HD}, concat(schemaname, '.', relname, '.', indexrelname) index_name, 8192 * idx_blks_read index_read_bytes,
  8192 * idx_blks_hit index_hit_bytes, {_ratio("idx_blks_read", "idx_blks_hit")} hit_ratio
  from inc where idx_blks_read > 0 or idx_blks_hit > 0)"""


def _top_index(kind: str) -> str:
    metric = f"index_{kind}_bytes"
    return f"""{_index_base()}
select * from (select {HD}, index_name, {metric}, hit_ratio, {_text(metric)} index_{kind}_text,
  cast(row_number() over (partition by host, database order by {metric} desc, index_name) as integer) rank
  from b where {metric} > 0) where rank <= 10"""


_DROPPABLE = "indkey <> '0' and conname is null and not indisunique and schemaname not in ('pg_catalog', 'pg_toast')"
_UNUSED = f"""u as (
  select distinct {HD}, concat(schemaname, '.', relname) table_name,
    concat(schemaname, '.', relname, '.', indexrelname) index_name
  from fx_indexes where {_DROPPABLE} and idx_scan = 0)"""
_NEVER_USED = f"""u as (
  select {HD}, concat(schemaname, '.', relname) table_name,
    concat(schemaname, '.', relname, '.', indexrelname) index_name
  from fx_indexes where {_DROPPABLE} group by 1, 2, 3, 4 having max(idx_scan) = 0)"""
_UNUSED_LIST = """select * from (select host, database, table_name, index_name,
  cast(row_number() over (partition by host, database order by table_name, index_name) as integer) rank from u)
where rank <= 500"""


def _index_sql() -> dict[str, str]:
    return {
        "index_base": f"{_index_base()} select * from b",
        "index_base_gaps": f"{_index_base('fx_indexes_gaps')} select * from b",
        "index_reads": _top_index("read"),
        "index_hits": _top_index("hit"),
        "unused_index_tables": f"""{_with("fx_indexes")}, {_UNUSED}, c as (
  select {HD}, table_name, count(*) unused_indexes from u group by {HD}, table_name)
select * from (select *, cast(row_number() over (partition by host, database order by unused_indexes desc, table_name)
  as integer) rank from c) where rank <= 10""",
        "unused_index_list": f"{_with('fx_indexes')}, {_UNUSED} {_UNUSED_LIST}",
        "unused_index_list_all": f"{_with('fx_indexes')}, {_NEVER_USED} {_UNUSED_LIST}",
        "index_findings": f"""{_index_base()}, {_UNUSED}
select distinct {HD}, 'index' category,
  'There are unused indexes; dropping them saves the I/O of keeping them up to date.' recommendation from u
union all
select distinct {HD}, 'index', 'Some indexes have a low cache-hit ratio; see the index I/O lists.' from b
where hit_ratio < 99""",
    }


# --- databases and the rest -----------------------------------------------------------------------------------------


def _database_cte(scope: str) -> str:
    keys = ", ".join(filter(None, [scope, "datname", "datid"]))
    counters = ["blks_read", "blks_hit"]
    total = f"over ({f'partition by {scope}' if scope else ''})"
    return f"""{_with("fx_database")}, inc as (
  select {keys}, {_sums(counters)} from ({_deltas("fx_database", keys, counters)}) group by {keys}),
s as (select *, sum(blks_read) {total} tot from inc),
r as (select {keys}, {_ratio("blks_read", "blks_hit")} hit_ratio, 8192 * blks_read read_bytes, 8192 * blks_hit hit_bytes,
  {_text("8192 * blks_read")} read_text, {_text("8192 * blks_hit")} hit_text,
  {_rounded("blks_read", "tot", 100)} io_percent
  from s where datid <> 0)"""


def _wait(columns: list[str]) -> str:
    named = ", ".join(f"coalesce({c}, 'CPU') {c}" for c in columns)
    groups = ", ".join(str(i + 3) for i in range(len(columns)))
    return f"{_with('fx_activity')} select {HD}, {named}, count(*) total_samples from fx_activity group by 1, 2, {groups}"


def _changes(source: str, keys: str, value: str) -> str:
    """Rows of ``source`` whose value differs from the row before, nulls compared as values."""
    return f"""(select *, row_number() over k n, lag({value}) over k before from {source}
  window k as (partition by {keys} order by snapshot_time)) where n = 1 or {value} is distinct from before"""


def _bgwriter_cte(fixture: str = "fx_bgwriter") -> str:
    keys = "host, database, stats_reset"
    counters = ["checkpoints_timed", "checkpoints_req", "buffers_checkpoint", "buffers_clean", "buffers_backend"]
    sizes = {"checkpoint": "buffers_checkpoint", "bgwriter": "buffers_clean", "backend": "buffers_backend"}
    return f"""{_with(fixture)}, inc as (
  select {HD}, max(stats_reset) last_reset, {_sums(counters)}, cast(sum(d_seconds) as bigint) span
  from ({_deltas(fixture, keys, counters)}) group by {HD}),
b as (select {HD}, last_reset, checkpoints_timed, checkpoints_req checkpoints_requested,
  {", ".join(f"8192 * {c} {n}_bytes" for n, c in sizes.items())},
  {", ".join(f"{_text('8192 * ' + c)} {n}_text" for n, c in sizes.items())},
  {_ratio("checkpoints_req", "checkpoints_timed")} timed_percent,
  {_rounded("(checkpoints_timed + checkpoints_req)", "span", 60)} checkpoints_per_minute from inc)"""


def _other_sql() -> dict[str, str]:
    fleet = "datname = database"
    named = "datname = 'NATION_7'"
    role = "case when standby then 'True' else 'False' end standby"
    return {
        "snapshot_summary": f"""{_with("fx_database")}
select {HD}, count(distinct snapshot_time) total_snapshots, min(snapshot_time) first_snapshot,
  max(snapshot_time) last_snapshot from fx_database group by {HD}""",
        "cluster_versions": f"""{_with("fx_version")}
select distinct {HD}, concat(split_part(version, ' ', 1), ' ', split_part(version, ' ', 2)) as version, aurora_version
from fx_version""",
        "database_io": f"{_database_cte(HD)} select * from r where {fleet}",
        "database_io_named": f"{_database_cte('')} select * from r where {named}",
        "remainder_io": f"{_database_cte(HD)} select * from r where not ({fleet})",
        "remainder_io_named": f"{_database_cte('')} select * from r where not ({named})",
        "role_change_points": f"""{_with("fx_database")}
select host, datname database, snapshot_time change_time, {role}
from {_changes("(select * from fx_database where datid <> 0)", "host, datname", "standby")}""",
        "role_at_start": f"""{_with("fx_database")}, c as (
  select {HD}, snapshot_time, bool_or(standby) standby from fx_database where datid <> 0 group by {HD}, snapshot_time)
select {HD}, snapshot_time change_time, {role} from c qualify row_number() over (partition by {HD} order by snapshot_time) = 1""",
        "database_findings": f"""{_database_cte(HD)}, {_with("fx_version").removeprefix("with ")}
select {HD}, 'database' category,
  'The cache-hit ratio is below 99%; review the buffer size and the statements that read most.' recommendation
from r where {fleet} and hit_ratio < 99 and host in (select host from fx_version where aurora_version is not null)""",
        "wait_events": _wait(["wait_event", "wait_event_type"]),
        "wait_event_types": _wait(["wait_event_type"]),
        "settings_current": f"{_with('fx_settings')} select distinct {HD}, name, setting, context, category from fx_settings",
        "settings_first_seen": f"""{_with("fx_settings")}, s as (
  select {HD}, name, setting, min(snapshot_time) change_time from fx_settings group by {HD}, name, setting)
select * from s qualify count(*) over (partition by {HD}, name) > 1""",
        "settings_change_points": f"""{_with("fx_settings")}
select {HD}, name, snapshot_time change_time, setting from {_changes("fx_settings", HD + ", name", "setting")}""",
        "bgwriter_summary": f"{_bgwriter_cte()} select * from b",
        "bgwriter_summary_gaps": f"{_bgwriter_cte('fx_bgwriter_gaps')} select * from b",
        "guard_database_reset": f"""{_with("fx_database_resets")}
select {HD}, count(distinct stats_reset) resets, count(distinct stats_reset) <= 1 ok from fx_database_resets
where datid <> 0 and datname = database group by {HD}""",
        "report_fleet_scope": f"{_database_cte('')} select * from r",
        "bgwriter_findings": f"""{_bgwriter_cte()}, {_with("fx_version").removeprefix("with ")}
select {HD}, 'bgwriter' category,
  'Under 90% of the checkpoints ran on schedule: WAL fills up before its time. Let more of it gather between two of them.' recommendation
from b where timed_percent < 90 and host not in (select host from fx_version where aurora_version is not null)""",
        "guard_snapshot_count": f"""{_with("fx_database")}
select {HD}, count(distinct snapshot_time) snapshots, count(distinct snapshot_time) >= 2 ok from fx_database group by {HD}""",
        "guard_stats_reset": f"""{_with("fx_bgwriter")}
select {HD}, count(distinct stats_reset) resets, count(distinct stats_reset) <= 1 ok from fx_bgwriter group by {HD}""",
        "guard_one_engine": f"""{_with("fx_version")}, c as (
  select count(distinct aurora_version is not null) engines,
    count(distinct regexp_extract(version, '^[^ ]+ ([0-9]+)', 1)) major_versions from fx_version)
select *, engines <= 1 and major_versions <= 1 ok from c""",
        "scalar_functions": f"""{_with("fx_statements")}
select host, username, queryid, query, snapshot_time, {_ratio("shared_blks_read", "shared_blks_hit")} ratio,
  {_rounded("total_exec_time", "calls")} ms_per_call, {_rounded("temp_blks_read", "shared_blks_hit", 100)} temp_percent,
  shared_blks_read * 8192 read_bytes, {_text("shared_blks_hit * 100")} hit_text from fx_statements""",
        "report_window": f"""{_with("fx_statements")}
select {STMT}, snapshot_time, calls from fx_statements
where snapshot_time between timestamp '2024-01-05' and timestamp '2024-01-20'""",
    }


# --- catalog joins --------------------------------------------------------------------------------------------------


def _catalog_sql() -> dict[str, str]:
    tag = "'1.2' capture_version"
    statement = (
        "select s.snapshot_time, usename username, userid, queryid, shared_blks_read, calls, total_exec_time, query, " + tag
    )
    return {
        "catalog_database_stats": f"""{_with("raw_stat_database", "raw_databases")}
select snapshot_time, datid, blks_read, blks_hit, datname, oldest_transaction_age, standby, {tag}
from raw_stat_database join raw_databases on datid = oid""",
        "catalog_active_sessions": f"""{_with("raw_activity")}
select snapshot_time, wait_event, wait_event_type, datid, datname, query, {tag} from raw_activity where state = 'active'""",
        "catalog_background_writer": f"{_with('raw_bgwriter')} select *, {tag} from raw_bgwriter",
        "catalog_server_settings": f"""{_with("raw_settings")}
select snapshot_time, name, setting, context, category, short_desc, {tag} from raw_settings""",
        "catalog_vacuum_progress": f"""{_with("raw_vacuum_progress", "raw_stat_tables")}
select p.*, t.schemaname, t.relname, {tag} from raw_vacuum_progress p join raw_stat_tables t
on p.relid = t.relid and p.snapshot_time = t.snapshot_time""",
        "catalog_statement_stats": f"""{_with("raw_statements", "raw_users", "raw_databases")}
{statement} from raw_statements s, raw_users
where userid = usesysid and calls > 0 and dbid = (select oid from raw_databases where datname = 'NATION_7')""",
        "catalog_statement_stats_mixed": f"""{_with("raw_statements", "raw_users", "raw_databases")}
select s.snapshot_time, usename username, userid, queryid, shared_blks_read, calls,
  case when userid % 2 = 1 then total_exec_time end total_exec_time, case when userid % 2 = 0 then total_exec_time end total_time,
  query, {tag} from raw_statements s, raw_users
where userid = usesysid and calls > 0 and dbid = (select oid from raw_databases where datname = 'NATION_7')""",
        "catalog_statement_stats_fleet": f"""{_with("raw_statements", "raw_users", "raw_databases")}
{statement}, n.datname database from raw_statements s
join raw_databases n on n.oid = case when queryid = 0 then 1 else dbid end
join raw_users on userid = usesysid where calls > 0 and dbid = n.oid""",
        "catalog_table_stats": f"""{_with("raw_statio_tables", "raw_stat_tables")}
select t.*, i.heap_blks_read, i.heap_blks_hit, {tag} from raw_stat_tables t join raw_statio_tables i
on t.relid = i.relid and t.schemaname = i.schemaname and t.relname = i.relname and t.snapshot_time = i.snapshot_time""",
        "catalog_index_stats": f"""{_with("raw_stat_indexes", "raw_statio_indexes", "raw_index_catalog", "raw_constraints")}
select a.*, i.idx_blks_read, i.idx_blks_hit, c.indisunique, c.indisprimary, c.indisvalid, c.indkey, d.conname, {tag}
from raw_stat_indexes a
join raw_statio_indexes i on a.snapshot_time = i.snapshot_time and a.relid = i.relid and a.schemaname = i.schemaname
  and a.relname = i.relname and a.indexrelid = i.indexrelid and a.indexrelname = i.indexrelname
join raw_index_catalog c on c.indrelid = a.relid and c.indexrelid = a.indexrelid
left join raw_constraints d on d.conindid = a.indexrelid""",
        "catalog_version": f"""{_with("fx_version")}
select host, database, snapshot_time, version, {tag}, cast(regexp_extract(version, '^[^ ]+ ([0-9]+)', 1) as integer) major_version,
  case when cast(regexp_extract(version, '^[^ ]+ ([0-9]+)', 1) as integer) >= 13 then 'split' else 'earlier' end profile
from fx_version""",
    }


def _lake_sql() -> dict[str, str]:
    window = "snapshot_time between timestamp '1996-01-01' and timestamp '1997-12-01'"
    return {
        "lake_round_trip": f"{_with('fx_tables')} select * from fx_tables",
        "lake_time_window": f"""{_with("fx_tables")}
select {HD}, snapshot_time, epoch(snapshot_time) snapshot_timestamp, relname, heap_blks_read from fx_tables
where {window} and host in ('h1', 'h2')""",
        "lake_csv_round_trip": f"{_with('fx_settings')} select * from fx_settings",
        "lake_statements_round_trip": f"{_with('fx_statements')} select * from fx_statements",
        "lake_extra_columns": f"{_with('fx_tables')} select *, heap_blks_read + 1 seq_scan from fx_tables",
        "lake_folded": f"{_index_base()} select * from b",
        "lake_compacted": f"{_with('fx_indexes')} select * from fx_indexes where {window}",
        "written_report": _vacuum(HD),
        "stream_ingest": f"{_with('fx_bgwriter')} select * from fx_bgwriter",
        "stream_delta": _delta_sql()["counter_delta_lag"],
        "lake_clustered_base": f"{_statement_base()} select * from t",
        "lake_clustered_deltas": f"""{_with("fx_statements")}
select {STMT}, snapshot_time, d_calls delta_calls, d_shared_blks_read delta_shared_blks_read from ({_deltas("fx_statements", STMT, ["calls", "shared_blks_read"])})""",
        "lake_views": f"""{_with("fx_activity", "fx_bgwriter")}
select w.host, w.samples, b.checkpoints from (select host, count(*) samples from fx_activity where wait_event is not null group by host) w
join (select host, max(checkpoints_timed) checkpoints from fx_bgwriter group by host) b on b.host = w.host""",
        "scalar_truncated": f"""{_with("fx_statements")}
select {STMT}, snapshot_time, cast(trunc((calls * 10 - shared_blks_read) / 7.0::double) as bigint) whole from fx_statements""",
        "guard_snapshot_minutes": f"""{_with("fx_database")}
select host, database, count(distinct snapshot_time) snapshots, count(distinct snapshot_time) >= 2 ok
from fx_database where datid % 2 = 0 or datid % 3 <> 0 group by host, database""",
        "stream_folded_ingest": f"{_index_base()} select * from b",
        "stream_wait_counts": f"""{_with("fx_activity")}
select date_trunc('hour', snapshot_time) window_start, date_trunc('hour', snapshot_time) + interval 1 hour window_end, host, database,
  coalesce(wait_event, 'CPU') wait_event, coalesce(wait_event_type, 'CPU') wait_event_type, count(*) total_samples
from fx_activity group by all""",
        "stream_wait_windows": """
with c as (
  select concat('h', cast(user_id % 3 as string)) host, date_trunc('hour', ts) window_start,
    coalesce(nullif(event_type, 'view'), 'CPU') wait_event,
    case when event_type = 'view' then 'CPU' else 'IO' end wait_event_type, count(*) total_samples
  from events group by 1, 2, 3, 4)
select *, window_start + interval 1 hour window_end from c
where window_start + interval 1 hour <= (select max(ts) from events) - interval 10 minutes""",
    }


# Result of the report: the query that has the same rows (lists of 10).
_REPORT_ROWS = {
    "snapshot_details": "snapshot_summary",
    "cluster_details": "cluster_versions",
    "database_io": "database_io",
    "remainder_io": "remainder_io",
    "wait_events": "wait_events",
    "wait_events_type": "wait_event_types",
    "parameters": "settings_current",
    "pg_setting_change_timeline": "settings_first_seen",
    "sql_r_io_stats": "sql_top_reads",
    "sql_h_io_stats": "sql_top_hits",
    "sql_w_io_stats": "sql_top_writes",
    "sql_tr_stats": "sql_top_temp_reads",
    "sql_tw_stats": "sql_top_temp_writes",
    "sql_stats_wg": "sql_top_wal",
    "findings_top_io_sql": "sql_top5_io",
    "bgwriter_stats": "bgwriter_summary",
    "bgwriter_findings": "bgwriter_findings",
    "index_reads": "index_reads",
    "index_hits": "index_hits",
    "index_usage": "unused_index_tables",
    "index_usage_2": "unused_index_list",
    "index_stats_findings": "index_findings",
    **{f"table_{f}_{k}s": f"table_{f}_{k}s" for f in _FAMILIES for k in ("read", "hit")},
    "vacuum_stats": "vacuum_efficiency",
    "table_stats_findings": "table_findings",
}


def _report_sql(known: dict[str, str]) -> str:
    """Rows per scope of every result and a sum over their values, each from the SQL of its own query."""
    role = f"""{_with("fx_database")}, c as (
  select {HD}, snapshot_time, bool_or(standby) standby from fx_database where datid <> 0 group by {HD}, snapshot_time)
select {HD}, snapshot_time change_time, case when standby then 'True' when not standby then 'False' end standby
from {_changes("c", HD, "standby")}"""
    low = f"""{_database_cte(HD)}, {_with("fx_version").removeprefix("with ")}
select {HD}, 'database' category,
  'The cache-hit ratio is below 99%; review the buffer size and the statements that read most.' recommendation
from r where datname = database and hit_ratio < 99 and (host, database) in (select (host, database) from fx_version where aurora_version is not null)"""
    off = f"""{_bgwriter_cte()}, {_with("fx_version").removeprefix("with ")}
select {HD}, 'bgwriter' category, 'Under 90% of the checkpoints ran on schedule: WAL fills up before its time. Let more of it gather between two of them.' recommendation from b where timed_percent < 90
and (host, database) not in (select (host, database) from fx_version where aurora_version is not null)"""
    texts = {name: known[query] for name, query in _REPORT_ROWS.items()} | {
        "database_role_timeline": role, "snapshot_details_findings": low, "bgwriter_findings": off
    }
    # The digest of a row: its values as named texts in order of the names, as ``row_digest`` makes it.
    value = (
        "coalesce(case when typeof(COLUMNS('(.*)')) in ('DOUBLE', 'FLOAT') then cast(cast(round(try_cast(cast(COLUMNS('(.*)') as varchar) as double) * 100) as bigint) as varchar) "
        "when typeof(COLUMNS('(.*)')) like 'TIMESTAMP%' then cast(epoch_us(try_cast(cast(COLUMNS('(.*)') as varchar) as timestamp)) as varchar) "
        "else cast(COLUMNS('(.*)') as varchar) end, '~') as \"\\1\""
    )
    parts = []
    for name, sql in texts.items():
        parts.append(f"""select any_value(host) as host, any_value(database) as database, count(*) as "rows", cast(sum(digest) as bigint) as digest, '{name}' as result
from (select rid, max(v) filter (n = 'host') as host, max(v) filter (n = 'database') as database,
    cast('0x' || substr(md5(string_agg(n || '=' || v, '|' order by n)), 1, 10) as bigint) as digest
  from (unpivot (select {value} from (select row_number() over () as rid, * from ({sql}))) on columns(* exclude (rid)) into name n value v)
  group by rid) group by host, database""")
    return " union all ".join(f"({p})" for p in parts)


def oracle_sql() -> dict[str, str]:
    known = _known_sql()
    return known | {"written_report_all": _report_sql(known)}


def _known_sql() -> dict[str, str]:
    return {
        **_delta_sql(),
        **_stat_delta_sql(),
        **_summary_sql(),
        **_statement_sql(),
        **_table_sql(),
        **_index_sql(),
        **_other_sql(),
        **_catalog_sql(),
        **_lake_sql(),
    }
