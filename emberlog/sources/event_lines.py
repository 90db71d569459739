"""Log lines derived from the ``events`` table.

The events table is the given data; this view writes each event as one line of
the log grammar, including corrupt, undated and truncated lines, so that every
query can run over the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from emberlog.sources.scratch import spread

# {TS} is the engine's own rendering of the event time with milliseconds.
LOG_LINES_SQL = """
with b as (
 select event_id, ts, user_id, event_type,
  case event_type when 'error' then 'ERROR' when 'signup' then 'WARN'
                  when 'purchase' then 'DEBUG' else 'INFO' end as lvl,
  case when user_id % 50 in (7, 13) then event_id % 5
       when user_id % 30 = 3 then (user_id + event_id % 2) % 5
       when user_id % 30 = 6 then (user_id + event_id % 3) % 5
       else user_id % 5 end as svc_i,
  case when user_id % 50 = 7 then '10.0.0.666'
       when user_id % 50 = 13 then '192.168.999.999'
       else concat('192.168.', cast(user_id % 4 as varchar(9)), '.',
                   cast(user_id as varchar(9))) end as ip,
  cast(floor(value * 20) as bigint) as rt,
  {TS} as tstr
 from {EVENTS}),
c as (select *,
  case svc_i when 0 then 'auth-service' when 1 then 'api-gateway'
             when 2 then 'user-service' when 3 then 'payment-service'
             else 'db-service' end as svc,
  case when lvl in ('ERROR', 'WARN') then
    case event_id % 6 when 0 then 'upstream call timeout'
      when 1 then 'login failed: access denied'
      when 2 then 'pool exhausted'
      when 3 then 'critical deadlock: attack suspected'
      when 4 then 'token rejected' else 'unhandled exception' end
   else 'request served' end as msg
 from b),
d as (select *,
  concat(' [', lvl, '] ', svc, ' - ', msg, ' | IP: ', ip, ' | User: user_',
         lpad(cast(user_id as varchar(9)), 4, '0')) as body,
  concat(' | ResponseTime: ', cast(rt as varchar(20)), 'ms') as tail from c)
select concat('server-', left(tstr, 10), '.log') as file_id, event_id + 1 as line_number,
 case when event_id % 97 = 0 then concat('corrupt record ', cast(event_id as varchar(20)))
      when event_id % 103 = 0 then concat('2024-02-30 00:00:00.000', body, tail)
      when event_id % 101 = 0 then concat(tstr, body)
      else concat(tstr, body, tail) end as value
from d
"""

SPARK_TS = "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSS')"
DUCKDB_TS = "strftime(ts, '%Y-%m-%d %H:%M:%S.%g')"


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file_id, line_number, value`` for every row of the events table, one log file per day."""
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    events = spread(events.select("event_id", "ts", "user_id", "event_type", "value"))
    return spark.sql(LOG_LINES_SQL.format(TS=SPARK_TS, EVENTS="{events}"), events=events)


def duckdb_log_lines() -> str:
    """The same view as SQL text for the oracle engine."""
    return LOG_LINES_SQL.format(TS=DUCKDB_TS, EVENTS="events")
