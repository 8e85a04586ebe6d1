"""Snapshot-shaped views over the driver's tables.

Each view is one SQL text that Spark and DuckDB both run; ``{orders}`` and the like stand for the tables. Counters
are running sums per entity, so they behave like server counters; ``host`` depends on the entity alone.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS: dict[str, str] = {
    "fx_statements": """
with i as (
  select date_trunc('day', ts) snapshot_time, user_id, event_type, count(*) calls,
    sum(cast(round(value * 100) as bigint)) tt, sum(cast(regexp_extract(props, '[0-9]+', 0) as bigint)) k
  from {events} group by date_trunc('day', ts), user_id, event_type)
select concat('h', cast(user_id % 3 as string)) host, 'app' database, snapshot_time,
  concat('user_', cast(user_id % 5 as string)) username, user_id queryid, event_type query,
  cast(sum(calls) over w as bigint) calls, cast(sum(tt) over w as bigint) total_exec_time,
  cast(sum(k) over w as bigint) shared_blks_read, cast(sum(tt) over w as bigint) shared_blks_hit,
  cast(sum(case when event_type = 'purchase' then k else 0 end) over w as bigint) shared_blks_written,
  cast(sum(case when event_type = 'error' then k else 0 end) over w as bigint) temp_blks_read,
  cast(sum(case when event_type = 'error' then calls else 0 end) over w as bigint) temp_blks_written,
  cast(sum(k) over w as bigint) blk_read_time, cast(sum(calls) over w as bigint) wal_records,
  cast(sum(calls) over w as bigint) wal_fpi, cast(sum(tt) over w as bigint) wal_bytes
from i window w as (partition by user_id, event_type order by snapshot_time)""",
    "fx_tables": """
with i as (
  select date_trunc('month', l_shipdate) snapshot_time, l_suppkey, count(*) n,
    sum(cast(l_quantity as bigint)) q, sum(cast(l_linenumber as bigint)) ln,
    sum(case when l_returnflag = 'R' then 1 else 0 end) r, sum(case when l_linenumber = 1 then 1 else 0 end) mv,
    sum(case when l_linenumber = 2 then 1 else 0 end) av
  from {lineitem} group by date_trunc('month', l_shipdate), l_suppkey)
select concat('h', cast(l_suppkey % 4 as string)) host, 'app' database, snapshot_time,
  case when l_suppkey % 10 = 0 then 'pg_toast' else concat('s', cast(l_suppkey % 3 as string)) end schemaname,
  concat('t', cast(l_suppkey as string)) relname,
  cast(sum(ln) over w as bigint) heap_blks_read, cast(sum(q) over w as bigint) heap_blks_hit,
  cast(sum(n) over w as bigint) idx_blks_read, cast(sum(q) over w as bigint) idx_blks_hit,
  case when l_suppkey % 2 = 0 then cast(sum(r) over w as bigint) end toast_blks_read,
  case when l_suppkey % 2 = 0 then cast(sum(n) over w as bigint) end toast_blks_hit,
  case when l_suppkey % 2 = 0 then cast(sum(mv) over w as bigint) end tidx_blks_read,
  case when l_suppkey % 2 = 0 then cast(sum(ln) over w as bigint) end tidx_blks_hit,
  cast(sum(n) over w as bigint) n_live_tup, cast(r as bigint) n_dead_tup,
  cast(sum(mv) over w as bigint) vacuum_count, cast(sum(av) over w as bigint) autovacuum_count
from i window w as (partition by l_suppkey order by snapshot_time)""",
    "fx_indexes": """
with i as (
  select date_trunc('month', l_shipdate) snapshot_time, p_brand, p_type, count(*) n,
    sum(cast(l_quantity as bigint)) q,
    sum(case when l_quantity > 49 and l_discount > 0.08 then 1 else 0 end) sc, min(p_size) sz
  from {lineitem} join {part} on l_partkey = p_partkey
  group by date_trunc('month', l_shipdate), p_brand, p_type)
select concat('h', substr(p_brand, 7, 1)) host, 'app' database, snapshot_time,
  case when p_type like '%BRASS%' then 'pg_catalog' else 'public' end schemaname,
  p_brand relname, p_type indexrelname,
  case when p_brand = 'Brand#11' then concat(p_type, '_pk') end conname, p_brand = 'Brand#11' indisunique,
  cast(sz % 4 as string) indkey, cast(sum(sc) over w as bigint) idx_scan,
  cast(sum(n) over w as bigint) idx_blks_read, cast(sum(q) over w as bigint) idx_blks_hit
from i window w as (partition by p_brand, p_type order by snapshot_time)""",
    "fx_database": """
with i as (
  select date_trunc('month', o_orderdate) snapshot_time, n_name datname, n_nationkey datid,
    n_regionkey regionkey, count(*) n, sum(cast(floor(o_totalprice / 8192) as bigint)) h,
    sum(case when o_orderstatus = 'F' then 1 else 0 end) f
  from {orders} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey
  group by date_trunc('month', o_orderdate), n_name, n_nationkey, n_regionkey),
d as (select n_regionkey, min(n_name) database from {nation} where n_nationkey <> 0 group by n_regionkey)
select concat('h', cast(regionkey as string)) host, database, snapshot_time, datname, cast(datid as bigint) datid,
  f = 0 standby, cast(sum(n) over w as bigint) blks_read, cast(sum(h) over w as bigint) blks_hit
from i join d on regionkey = n_regionkey window w as (partition by datname, datid order by snapshot_time)""",
    "fx_settings": """
select concat('h', cast(o_custkey % 2 as string)) host, 'app' database,
  date_trunc('month', o_orderdate) snapshot_time, concat('param_', cast(o_custkey % 40 as string)) name,
  nullif(min(o_orderstatus), 'P') setting, case when o_custkey % 40 < 20 then 'user' else 'sighup' end context,
  case when o_custkey % 40 < 10 then 'Memory' else 'WAL' end category
from {orders} group by date_trunc('month', o_orderdate), o_custkey % 40, o_custkey % 2""",
    "fx_activity": """
select concat('h', cast(user_id % 3 as string)) host, 'app' database, date_trunc('hour', ts) snapshot_time,
  nullif(event_type, 'view') wait_event,
  case when event_type = 'view' then null when event_type in ('click', 'signup') then 'Client' else 'IO' end
    wait_event_type,
  props query
from {events}""",
    "fx_bgwriter": """
with i as (
  select concat('h', cast(user_id % 3 as string)) host, date_trunc('day', ts) snapshot_time,
    date_trunc('week', ts) stats_reset,
    sum(case when event_type in ('view', 'click') then 1 else 0 end) t,
    sum(case when event_type = 'error' then 1 else 0 end) r, sum(cast(floor(value) as bigint)) b, count(*) n
  from {events} group by concat('h', cast(user_id % 3 as string)), date_trunc('day', ts), date_trunc('week', ts))
select host, 'app' database, snapshot_time, stats_reset,
  cast(sum(t) over w as bigint) checkpoints_timed, cast(sum(r) over w as bigint) checkpoints_req,
  cast(sum(b) over w as bigint) buffers_checkpoint, cast(sum(n) over w as bigint) buffers_clean,
  cast(sum(r) over w as bigint) buffers_backend
from i window w as (partition by host, stats_reset order by snapshot_time)""",
    "fx_version": """
select distinct concat('h', cast(o_custkey % 4 as string)) host, 'app' database,
  date_trunc('month', o_orderdate) snapshot_time,
  concat('PostgreSQL ', cast(case when o_orderdate < timestamp '1996-01-01' then 12 else 13 end as string), '.',
    cast(o_custkey % 4 as string), ' on x86_64, 64-bit') as version,
  case when o_custkey % 4 < 2 then concat('3.', cast(o_custkey % 4 as string)) end aurora_version
from {orders}""",
    # Statistics with nulls between values, and with columns that one host does not have.
    "fx_statements_gaps": """
select host, database, snapshot_time, username, queryid, query,
  case when queryid % 5 = 0 and day(snapshot_time) % 7 = 3 then null else calls end calls, total_exec_time,
  case when day(snapshot_time) % 5 = 2 then null else shared_blks_read end shared_blks_read, shared_blks_hit,
  shared_blks_written, temp_blks_read, temp_blks_written,
  case when host = 'h1' and day(snapshot_time) = 9 then null else blk_read_time end blk_read_time,
  case when host = 'h2' and day(snapshot_time) < 12 then null else wal_records end wal_records,
  case when host = 'h2' and day(snapshot_time) < 12 then null else wal_fpi end wal_fpi,
  case when day(snapshot_time) % 4 = 1 then null else wal_bytes end wal_bytes
from fx_statements""",
    "fx_statements_missing": """
select host, database, snapshot_time, username, queryid, query, calls, total_exec_time, shared_blks_read, shared_blks_hit,
  shared_blks_written, temp_blks_read, temp_blks_written, case when host <> 'h1' then blk_read_time end blk_read_time,
  case when host <> 'h1' then wal_records end wal_records, case when host <> 'h1' then wal_fpi end wal_fpi,
  case when host <> 'h1' then wal_bytes end wal_bytes
from fx_statements""",
    "fx_bgwriter_gaps": """
select host, database, snapshot_time, stats_reset, case when host <> 'h1' then checkpoints_timed end checkpoints_timed,
  case when day(snapshot_time) % 3 = 1 then null else checkpoints_req end checkpoints_req, buffers_checkpoint,
  case when day(snapshot_time) % 4 = 2 then null else buffers_clean end buffers_clean, buffers_backend
from fx_bgwriter""",
    "fx_indexes_gaps": """
select host, database, snapshot_time, schemaname, relname, indexrelname,
  case when month(snapshot_time) % 5 = 2 then null else idx_blks_read end idx_blks_read,
  case when relname = 'Brand#12' then null else idx_blks_hit end idx_blks_hit
from fx_indexes""",
    "fx_database_resets": """
select host, database, snapshot_time, datname, datid,
  case when host = 'h1' and snapshot_time >= timestamp '1995-01-01' then timestamp '1995-01-01' end stats_reset
from fx_database union all
select host, database, snapshot_time, datname, datid, timestamp '1993-01-01' stats_reset
from fx_database where host = 'h1'""",
    "fx_statements_window": """
select * from fx_statements where snapshot_time >= timestamp '2024-01-05 06:00:00' and snapshot_time <= timestamp '2024-01-20 00:00:00'""",
    # Tables that were dropped and created again under their name, some of them with an id that comes back.
    "fx_tables_lives": """
select host, database, snapshot_time, schemaname, relname, relid, case when relid > 100000 then heap_blks_read % 97 else heap_blks_read end heap_blks_read,
  case when month(snapshot_time) = 5 then null else idx_blks_read end idx_blks_read
from (select *, cast(substr(relname, 2) as bigint) + case when cast(substr(relname, 2) as bigint) % 7 = 0 and year(snapshot_time) >= 1995 then 100000
    when cast(substr(relname, 2) as bigint) % 5 = 0 and year(snapshot_time) % 2 = 0 then 200000 else 0 end relid
  from fx_tables)""",
    # Raw catalog extracts, one row per object and monthly or daily capture.
    "raw_databases": """
select n_nationkey oid, n_name datname, n_nationkey * 1000 oldest_transaction_age, n_regionkey % 2 = 0 standby
from {nation}""",
    "raw_stat_database": """
select date_trunc('month', o_orderdate) snapshot_time, c_nationkey datid, count(*) blks_read,
  cast(sum(cast(floor(o_totalprice / 8192) as bigint)) as bigint) blks_hit
from {orders} join {customer} on o_custkey = c_custkey group by date_trunc('month', o_orderdate), c_nationkey""",
    "raw_activity": """
select date_trunc('hour', ts) snapshot_time, nullif(event_type, 'view') wait_event, 'IO' wait_event_type,
  user_id % 25 datid, concat('db_', cast(user_id % 25 as string)) datname, props query, event_type backend_type,
  case when value > 50 then 'active' when value > 10 then 'idle' end state
from {events}""",
    "raw_bgwriter": """
select date_trunc('day', ts) snapshot_time, count(*) checkpoints_timed, count(distinct user_id) checkpoints_req
from {events} group by date_trunc('day', ts)""",
    "raw_settings": """
select date_trunc('month', o_orderdate) snapshot_time, o_orderpriority name, min(o_orderstatus) setting,
  'user' context, 'Memory' category, cast(null as string) short_desc, max(o_totalprice) boot_val
from {orders} group by date_trunc('month', o_orderdate), o_orderpriority""",
    "raw_users": "select c_custkey usesysid, c_name usename, c_acctbal from {customer}",
    "raw_statements": """
select date_trunc('day', ts) snapshot_time, user_id userid, user_id % 25 dbid, event_id % 7 queryid,
  concat(event_type, ' ', cast(event_id % 7 as string)) query,
  cast(sum(case when event_type = 'signup' then 0 else 1 end) as bigint) calls,
  cast(sum(cast(round(value * 100) as bigint)) as bigint) total_exec_time, count(*) shared_blks_read
from {events} group by date_trunc('day', ts), user_id, event_id % 7, event_type""",
    "raw_statio_tables": """
select date_trunc('month', l_shipdate) snapshot_time, l_suppkey relid,
  case when l_suppkey % 10 = 0 then 'pg_toast' else 'public' end schemaname,
  concat('t', cast(l_suppkey as string)) relname, count(*) heap_blks_read,
  cast(sum(cast(l_quantity as bigint)) as bigint) heap_blks_hit
from {lineitem} group by date_trunc('month', l_shipdate), l_suppkey""",
    "raw_stat_tables": """
select date_trunc('month', l_shipdate) snapshot_time, l_suppkey relid,
  case when l_suppkey % 10 = 0 then 'pg_toast' else 'public' end schemaname,
  concat('t', cast(case when l_suppkey % 17 = 0 then 0 else l_suppkey end as string)) relname,
  count(*) n_live_tup, count(distinct l_orderkey) n_dead_tup
from {lineitem} group by date_trunc('month', l_shipdate), l_suppkey""",
    "raw_vacuum_progress": """
select date_trunc('month', l_shipdate) snapshot_time,
  case when l_linenumber < 7 then l_suppkey + 100000000 else l_suppkey end relid, l_returnflag phase,
  count(*) heap_blks_total
from {lineitem} group by 1, 2, 3""",
    "raw_stat_indexes": """
select date_trunc('month', l_shipdate) snapshot_time, cast(l_suppkey % 50 as bigint) relid, 'public' schemaname,
  concat('t', cast(l_suppkey % 50 as string)) relname, l_suppkey indexrelid,
  concat('i', cast(l_suppkey as string)) indexrelname,
  cast(sum(case when l_discount > 0.09 then 1 else 0 end) as bigint) idx_scan, count(*) idx_tup_read, count(*) idx_tup_fetch
from {lineitem} group by date_trunc('month', l_shipdate), l_suppkey""",
    "raw_statio_indexes": """
select date_trunc('month', l_shipdate) snapshot_time, cast(l_suppkey % 50 as bigint) relid, 'public' schemaname,
  concat('t', cast(l_suppkey % 50 as string)) relname, l_suppkey indexrelid,
  concat('i', cast(l_suppkey as string)) indexrelname, count(*) idx_blks_read,
  cast(sum(cast(l_quantity as bigint)) as bigint) idx_blks_hit
from {lineitem} group by date_trunc('month', l_shipdate), l_suppkey""",
    "raw_index_catalog": """
select s_suppkey indexrelid, cast(s_suppkey % 50 as bigint) indrelid, s_nationkey % 3 = 0 indisunique,
  s_nationkey % 6 = 0 indisprimary, true indisvalid, cast(s_nationkey % 4 as string) indkey
from {supplier}""",
    "raw_constraints": """
select s_suppkey conindid, concat('c', cast(s_suppkey as string)) conname from {supplier} where s_suppkey % 3 = 0
union all
select s_suppkey conindid, concat('fk', cast(s_suppkey as string)) conname from {supplier} where s_suppkey % 6 = 0
union all
select s_suppkey + 100000000 conindid, concat('x', cast(s_suppkey as string)) conname from {supplier}""",
}


# Views that are made from another view.
OVER = {
    "fx_statements_gaps": "fx_statements",
    "fx_statements_missing": "fx_statements",
    "fx_bgwriter_gaps": "fx_bgwriter",
    "fx_indexes_gaps": "fx_indexes",
    "fx_database_resets": "fx_database",
    "fx_statements_window": "fx_statements",
    "fx_tables_lives": "fx_tables",
}


def view_text(name: str) -> str:
    text = VIEWS[name]
    return f"with {OVER[name]} as ({VIEWS[OVER[name]]}) {text}" if name in OVER else text


def tables_in(sql: str) -> set[str]:
    return set(re.findall(r"\{(\w+)\}", sql))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = view_text(name)
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in tables_in(sql)})


def view_sql(name: str) -> str:
    """The view's text with the plain table names."""
    text = view_text(name)
    return text.format(**{t: t for t in tables_in(text)})
