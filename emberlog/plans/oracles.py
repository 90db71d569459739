"""SQL statements of the oracle engine, one per deterministic query.

They are written against the same tables, independently of the Spark plans.
"""

from __future__ import annotations

from emberlog.plans.catalog import FIXED_CENTERS, FIXED_FOREST, FOREST_FEATURES, LINES_PER_FILE, REPORT_ID, REPORT_SECONDS, REPORT_TIME
from emberlog.sources.event_lines import duckdb_log_lines

_TS = "'%Y-%m-%d %H:%M:%S.%g'"

# Common table expressions, each building on the ones before it.
_CTES: list[tuple[str, str]] = [
    ("log_lines", duckdb_log_lines()),
    (
        "parsed",
        rf"""select file_id, line_number, value,
  try_strptime(nullif(regexp_extract(value, '^(\d{{4}}-\d{{2}}-\d{{2}} \d{{2}}:\d{{2}}:\d{{2}}\.\d{{3}})', 1), ''), {_TS}) as timestamp,
  regexp_extract(value, '\[(INFO|WARN|ERROR|DEBUG)\]', 1) as level,
  regexp_extract(value, '\] ([a-z\-]+) -', 1) as service,
  regexp_extract(value, '- (.*?) \|', 1) as message,
  regexp_extract(value, 'IP: ([0-9\.]+)', 1) as ip_address,
  regexp_extract(value, 'User: ([a-z0-9_]+)', 1) as "user",
  try_cast(regexp_extract(value, 'ResponseTime: (\d+)ms', 1) as int) as response_time
 from log_lines""",
    ),
    ("valid", "select * from parsed where level <> '' and service <> ''"),
    (
        "all_features",
        """select *,
  (level = 'ERROR')::int as level_error, (level = 'WARN')::int as level_warn,
  (level = 'INFO')::int as level_info,
  hour(timestamp)::int as hour, minute(timestamp)::int as minute,
  length(message)::int as message_length,
  regexp_matches(message, '(?i)(timeout|error|exception|failed|critical|denied|exhausted|deadlock)')::int as has_error_keyword,
  regexp_matches(ip_address, '(999|666|0\\.0\\.0\\.0)')::int as suspicious_ip,
  coalesce(response_time > 1000, false)::int as high_response_time,
  coalesce(response_time > 5000, false)::int as very_high_response_time
 from parsed""".replace("\\\\", "\\"),
    ),
    ("features", "select * from all_features where level <> '' and service <> ''"),
    (
        "scored",
        "select *, "
        + "case level when 'ERROR' then 0.4::double when 'WARN' then 0.2::double else 0.0::double end"
        + " + case when response_time > 5000 then 0.3::double when response_time > 1000 then 0.1::double else 0.0::double end"
        + "".join(
            f" + case when contains(lower(message), '{w}') then 0.2::double else 0.0::double end"
            for w in (
                "timeout", "error", "exception", "failed", "critical",
                "denied", "exhausted", "deadlock", "breach", "attack",
            )
        )
        + " as anomaly_score from parsed",
    ),
    (
        "labelled",
        """select *,
  case when anomaly_score >= 0.9::double then 'critical' when anomaly_score >= 0.7::double then 'high'
       when anomaly_score >= 0.5::double then 'medium' else 'low' end as severity
 from scored""",
    ),
    ("anomalies", "select * from labelled where anomaly_score >= 0.4::double"),
    (
        "listed",
        """select file_id, timestamp, 'service' as kind, service as entity from anomalies
 union all select file_id, timestamp, 'ip_address', ip_address from anomalies""",
    ),
    (
        "alert_rows",
        """select 'alert_' || file_id || '_' || line_number as id, upper(severity) as severity,
  case severity when 'critical' then 1 when 'high' then 2 else 3 end as priority,
  upper(severity) || ' anomaly in ' || service || ': ' || message as message,
  service, ip_address, timestamp, anomaly_score, line_number, file_id,
  level, "user", response_time, 'pattern_spark' as analysis_type
 from anomalies where anomaly_score >= 0.5::double""",
    ),
    (
        "ends",
        """select 'ip' as src_type, ip_address as src, service as dst, level, response_time from valid
 union all select 'user', "user", service, level, response_time from valid""",
    ),
    (
        "edges",
        """select src_type, src, dst, count(*) as weight, avg(response_time) as avg_response_time,
  count(*) filter (level = 'ERROR') as error_count
 from ends group by all""",
    ),
    (
        "vertices",
        """select distinct service as id, 'service' as type from valid
 union all select distinct ip_address, 'ip' from valid
 union all select distinct "user", 'user' from valid""",
    ),
    (
        "nodes",
        """select v.id, v.type, coalesce(o.n, 0) as out_degree, coalesce(o.w, 0)::bigint as total_interactions,
  coalesce(i.n, 0) as in_degree, coalesce(i.w, 0)::bigint as total_incoming
 from vertices v
 left join (select src, count(*) as n, sum(weight) as w from edges group by src) o on o.src = v.id
 left join (select dst, count(*) as n, sum(weight) as w from edges group by dst) i on i.dst = v.id""",
    ),
    (
        "degree_scores",
        """select *, case when type = 'ip' then out_degree / (select coalesce(nullif(avg(out_degree), 0), 1) from nodes where type = 'ip')
  else 1.0::double end as degree_anomaly_score from nodes""",
    ),
    (
        "scored_nodes",
        """select *, case when degree_anomaly_score > 3 then 1.0::double when degree_anomaly_score > 2 then 0.8::double
  when degree_anomaly_score > 1.5 then 0.5::double else 0.1::double end as graph_anomaly_score from degree_scores""",
    ),
    (
        "bad_ips",
        "select id, graph_anomaly_score, out_degree from scored_nodes where type = 'ip' and graph_anomaly_score > 0.6::double",
    ),
    (
        "connections",
        """select src as suspicious_ip, dst as target_service, weight, error_count, graph_anomaly_score
 from edges join bad_ips on src = id""",
    ),
    (
        "all_ends",
        """select ip_address as src, service as dst, level, response_time, 'ip' as src_type from parsed
 union all select "user", service, level, response_time, 'user' from parsed""",
    ),
    (
        "all_edges",
        """select src_type, src, dst, count(*) as weight, avg(response_time) as avg_response_time,
  count(*) filter (level = 'ERROR') as error_count from all_ends group by all""",
    ),
    (
        "named_nodes",
        """select distinct service as id, 'service' as type from parsed where service <> ''
 union all select distinct ip_address, 'ip' from parsed where ip_address <> ''
 union all select distinct "user", 'user' from parsed where "user" <> ''""",
    ),
    (
        "links",
        """select src as source, dst as target, weight as value from all_edges
 semi join named_nodes s on src = s.id semi join named_nodes d on dst = d.id""",
    ),
]

_FEATURES = [
    "response_time", "level_error", "level_warn", "level_info",
    "message_length", "has_error_keyword", "suspicious_ip", "high_response_time",
]



def _path(tree: int, node: int = 0) -> str:
    """Path length of a row in a literal tree, as nested cases."""
    _, _, feature, split, below, above, path = next(r for r in FIXED_FOREST if r[:2] == (tree, node))
    if feature < 0:
        return f"{path}::double"
    return f"case when {FOREST_FEATURES[feature]} < {split} then {_path(tree, below)} else {_path(tree, above)} end"


_TREES = sorted({r[0] for r in FIXED_FOREST})
# c(256) = 2 H(255) - 2 * 255 / 256 with H(n) = ln(n) + 0.5772156649015329
_ISOLATION = f"pow(2::double, -(({' + '.join(_path(t) for t in _TREES)}) / {len(_TREES)}) / (2 * (ln(255::double) + 0.5772156649015329) - 2 * 255 / 256.0::double))"
_LARGE = [f"case when {j} in (select cluster from large) then d{j} end" for j in range(len(FIXED_CENTERS))]

_CTES += [
    ("complete", "select * from features where response_time is not null"),
    (
        "moments",
        "select "
        + ", ".join(f"avg({n}) as m_{n}, coalesce(stddev_samp({n}), 0) as s_{n}" for n in _FEATURES)
        + " from complete",
    ),
    (
        "scaled",
        "select f.*, "
        + ", ".join(f"case when s_{n} = 0 then 0 else ({n} - m_{n}) / s_{n} end as z_{n}" for n in _FEATURES)
        + " from features f cross join moments",
    ),
    (
        "squares",
        "select *, "
        + ", ".join(
            " + ".join(f"pow(z_{n} - ({c}), 2)" for n, c in zip(_FEATURES, center)) + f" as d{j}"
            for j, center in enumerate(FIXED_CENTERS)
        )
        + " from scaled",
    ),
    (
        "assigned",
        """select *, case when response_time is null then null
   when d0 <= least(d1, d2, d3, d4) then 0 when d1 <= least(d2, d3, d4) then 1
   when d2 <= least(d3, d4) then 2 when d3 <= d4 then 3 else 4 end as cluster,
  case when response_time is not null then sqrt(least(d0, d1, d2, d3, d4)) end as distance_to_center
 from squares""",
    ),
    (
        "distances",
        """select max(distance_to_center) as max_distance, avg(distance_to_center) as avg_distance,
  coalesce(nullif(stddev_samp(distance_to_center), 0), 1) as stddev_distance from assigned""",
    ),
    (
        "linear",
        """select *, case when distance_to_center is null then 0.5::double
  else least(distance_to_center / 3, 1) end as base from assigned""",
    ),
    (
        "rare",
        """select cluster from assigned where cluster is not null group by cluster
 having count(*) < 0.05 * (select count(*) from complete)""",
    ),
    (
        "boosted",
        """select *, case when response_time > 5000 then 0.3::double when response_time > 2000 then 0.1::double else 0 end as slow_part,
  case when service in ('auth-service', 'security-service') then
    case level when 'ERROR' then 0.2::double when 'WARN' then 0.1::double else 0 end else 0 end as service_part,
  case when contains(ip_address, '999') or contains(ip_address, '666') or starts_with(ip_address, '0.')
    then 0.25::double else 0 end as ip_part
 from linear""",
    ),
    (
        "enhanced",
        """select *, least(base + case when cluster in (select cluster from rare) then 0.2::double else 0 end
  + slow_part + service_part + ip_part, 1) as enhanced from boosted""",
    ),
    (
        "sizes",
        "select cluster, count(*) as n from assigned where cluster is not null group by cluster",
    ),
    (
        "large",
        "select cluster from sizes where n >= least(0.05 * (select sum(n) from sizes), (select max(n) from sizes))",
    ),
    (
        "measured",
        f"""select *, case when cluster in (select cluster from large) then distance_to_center
  else sqrt(least({", ".join(_LARGE)})) end as sized_distance from assigned where cluster is not null""",
    ),
    (
        "sized_figures",
        "select avg(sized_distance) as mean_d, coalesce(nullif(stddev_samp(sized_distance), 0), 1) as std_d from measured",
    ),
    (
        "combined",
        f"""select *, 0.6::double * kmeans_score + 0.4::double * isolation_score as final_score from (
 select *, greatest(0, least(1, ((sized_distance - mean_d) / std_d + 3) / 6)) as kmeans_score, {_ISOLATION} as isolation_score
 from measured cross join sized_figures)""",
    ),
    (
        "rotated",
        f"""select 'server-' || lpad(((line_number - 1) // {LINES_PER_FILE})::varchar, 9, '0') as file,
  line_number, value from log_lines""",
    ),
    ("spoiled", "select distinct file from rotated where starts_with(value, 'corrupt record')"),
    (
        "rotated_valid",
        """select r.file, p.level from rotated r join valid p using (line_number)""",
    ),
]

_STATS = """count(*) as total_logs, count(*) filter (anomaly_score >= 0.4::double) as anomalies_found,
  count(*) filter (anomaly_score >= 0.9::double) as critical_alerts,
  count(*) filter (anomaly_score >= 0.7::double and anomaly_score < 0.9::double) as high_risk_alerts,
  count(*) filter (anomaly_score >= 0.5::double and anomaly_score < 0.7::double) as medium_risk_alerts,
  0::bigint as low_risk_alerts,
  count(*) filter (level = 'ERROR') as error_logs,
  count(distinct service) filter (anomaly_score >= 0.4::double and service <> '') as services_count,
  count(distinct ip_address) filter (anomaly_score >= 0.4::double and ip_address <> '') as suspicious_ips_count,
  count(distinct message) filter (anomaly_score >= 0.4::double and level = 'ERROR') as error_patterns_count"""


def _sql(body: str) -> str:
    """A statement with the common table expressions it needs."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        words = set(text.replace("(", " ").replace(")", " ").replace(",", " ").split())
        for name, sql in _CTES:
            if name in words and name not in needed:
                needed.add(name)
                visit(sql)

    visit(body)
    ctes = ",\n".join(f"{name} as ({sql})" for name, sql in _CTES if name in needed)
    return f"with {ctes}\n{body}"


def _ts(column: str = "timestamp", alias: str | None = None) -> str:
    return f"strftime({column}, {_TS}) as {alias or column}"


_PARSED = f'file_id, line_number, {_ts()}, level, service, message, ip_address, "user", response_time'
_RECORD = _PARSED + ", round(anomaly_score, 6) as anomaly_score, 'pattern_spark' as analysis_type, null::int as cluster"
_BANDS = ", ".join(
    f"count(*) filter (severity = '{s}') as {s}" for s in ("critical", "high", "medium", "low")
)
_ALERT = f"""id, severity, priority, message, service, ip_address, {_ts()}, round(anomaly_score, 6) as anomaly_score,
 line_number, file_id, level, "user", response_time, analysis_type"""


def _page(columns: str, source: str, order: str, number: int, per_page: int, where: str = "true") -> str:
    return f"""select {columns}, {number} as page, (select count(*) from {source} where {where}) as total,
 ceil((select count(*) from {source} where {where}) / {per_page}.0)::bigint as pages
 from {source} where {where} order by {order} limit {per_page} offset {(number - 1) * per_page}"""


_ALERT_ORDER = "priority, timestamp desc nulls last, file_id, line_number"
_RECENT = "select * from anomalies order by timestamp desc nulls last, file_id desc, line_number desc limit 100"


def _windows(frames: str) -> str:
    return f"""select {_ts('w', 'window_start')}, strftime(w + len, {_TS}) as window_end, service, count(*) as log_count,
 round(avg(response_time), 6) as avg_response_time, round(stddev_samp(response_time), 6) as stddev_response_time,
 count(*) filter (level = 'ERROR') as error_count, count(*) filter (level = 'WARN') as warn_count,
 count(*) filter (suspicious_ip = 1) as suspicious_ip_count
 from ({frames}) group by w, len, service"""


_TUMBLING = """select *, time_bucket(interval 1 minute, timestamp) as w, interval 1 minute as len
 from features where timestamp is not null"""
_SLIDING = """select f.*, time_bucket(interval 10 second, timestamp) - to_seconds(10 * k) as w, interval 30 second as len
 from features f cross join range(3) r(k) where timestamp is not null"""
_EDGE = "src, dst, weight, round(avg_response_time, 6) as avg_response_time, error_count"
_NODE = "id, type, out_degree, total_interactions, in_degree, total_incoming"
_NODE_SCORE = f"{_NODE}, round(degree_anomaly_score, 6) as degree_anomaly_score, graph_anomaly_score"
_VIEW = """select l.file_id, l.line_number, trim(l.value) as content, a.line_number is not null as is_anomaly,
 round(coalesce(a.anomaly_score, 0), 6) as anomaly_score, coalesce(a.severity, 'normal') as severity
 from log_lines l left join anomalies a using (file_id, line_number) where trim(l.value) <> ''"""

_SEEN = f"count(*) as anomaly_count, strftime(min(timestamp), {_TS}) as first_seen, strftime(max(timestamp), {_TS}) as last_seen"

_RULE = "-" * 80
_DOUBLE_RULE = "=" * 80


def _heading(section: int, text: str) -> str:
    return " union all ".join(
        f"select {section} as section, {i} as ord, '' as detail, {t} as line"
        for i, t in ((-4, "''"), (-3, f"'{_RULE}'"), (-2, text), (-1, f"'{_RULE}'"))
    )


def _block(section: int, rows: str, title: str, fields: list[tuple[str, str]]) -> str:
    lines = [(0, "''"), (1, f"'[{title} ' || rk || ']'")] + [
        (i, f"'  {label}: ' || {expr}") for i, (label, expr) in enumerate(fields, start=2)
    ]
    return " union all ".join(
        f"select {section}, rk * 10 + {i}, '', {expr} from ({rows})" for i, expr in lines
    )


_STAMP = f"coalesce(strftime(timestamp, {_TS}), 'N/A')"
_TOTALS = f"(select {_STATS} from scored)"
_ALERT_SUM = "(critical_alerts + high_risk_alerts + medium_risk_alerts)"
_REPORT_PARTS = [
    *[
        f"select 0 as section, {i} as ord, '' as detail, '{t}' as line"
        for i, t in enumerate(
            [_DOUBLE_RULE, "Findings in service logs", _DOUBLE_RULE, "", f"Analysis: {REPORT_ID}"]
        )
    ],
    "select 0, 5, '', case when count(distinct file_id) = 1 then 'Source: ' || min(file_id) else 'Source: ' || count(distinct file_id) || ' files' end from scored",
    f"select 0, 6, '', 'Analysed: {REPORT_TIME}'",
    f"select 0, 7, '', 'Seconds taken: {REPORT_SECONDS:.2f}'",
    _heading(1, "'Overview'"),
    f"select 1, 0, '', 'Lines read: ' || format('{{:,}}', total_logs) from {_TOTALS}",
    f"select 1, 1, '', 'Lines marked: ' || format('{{:,}}', anomalies_found) from {_TOTALS}",
    f"select 1, 2, '', 'Alerts: ' || format('{{:,}}', {_ALERT_SUM}) from {_TOTALS}",
    "select 1, 3, '', 'Method: keyword and threshold rules'",
    _heading(2, "'Alerts by severity'"),
    f"select 2, 0, '', 'critical: ' || critical_alerts from {_TOTALS}",
    f"select 2, 1, '', 'high: ' || high_risk_alerts from {_TOTALS}",
    f"select 2, 2, '', 'medium: ' || medium_risk_alerts from {_TOTALS}",
    f"select 2, 3, '', 'low: ' || low_risk_alerts from {_TOTALS}",
    _heading(3, "'Errors, services, addresses'"),
    f"select 3, 0, '', 'Share of errors: ' || printf('%.2f%%', round(error_logs / total_logs * 100, 2)) from {_TOTALS}",
    "select 3, 100, '', 'Services with marked lines:'",
    "select distinct 3, 101, service, '  - ' || service from anomalies where service <> ''",
    "select 3, 200, '', 'Addresses by marked lines (10 listed):'",
    """select 3, 200 + rk, '', '  ' || rk || '. ' || ip_address from (
 select ip_address, row_number() over (order by count(*) desc, ip_address) as rk from anomalies
 where ip_address <> '' group by ip_address) where rk <= 10""",
    "select 3, 2305843009213693952, '', 'Services by marked lines:'",
    """select 3, 4611686018427387904 - count(*), service, '  - ' || service || ': ' || count(*) || ' lines'
 from anomalies where service <> '' group by service""",
    _heading(4, f"(select 'Marked lines in order (50 listed of ' || anomalies_found || ')' from {_TOTALS})"),
    _block(
        4,
        "select *, row_number() over (order by file_id, line_number) as rk from anomalies qualify rk <= 50",
        "Line",
        [
            ("time", _STAMP),
            ("service", "coalesce(nullif(service, ''), 'N/A')"),
            ("level", "coalesce(nullif(level, ''), 'N/A')"),
            ("message", "coalesce(nullif(message, ''), 'N/A')"),
            ("address", "coalesce(nullif(ip_address, ''), 'N/A')"),
            ("score", "printf('%.4f', anomaly_score)"),
            ("severity", "severity"),
        ],
    ),
    _heading(5, f"(select 'Most urgent alerts (30 listed of ' || {_ALERT_SUM} || ')' from {_TOTALS})"),
    _block(
        5,
        f"select *, row_number() over (order by {_ALERT_ORDER}) as rk from alert_rows qualify rk <= 30",
        "Alert",
        [
            ("time", _STAMP),
            ("service", "coalesce(nullif(service, ''), 'N/A')"),
            ("severity", "severity"),
            ("text", "message"),
        ],
    ),
    _heading(6, "'What to do'"),
    f"""select 6, 0, '', '- Look at the critical alerts first.'
 from {_TOTALS} where critical_alerts > 0""",
    f"""select 6, 1, '', '- Many high alerts: check which addresses they come from.'
 from {_TOTALS} where high_risk_alerts > 10""",
    f"""select 6, 2, '', '- More than a tenth of the lines are marked: check sources and threshold.'
 from {_TOTALS} where anomalies_found > total_logs * 0.1""",
    f"""select 6, 3, '', '- More than one line in twenty is an error: check the services above.'
 from {_TOTALS} where error_logs > total_logs * 0.05""",
    "select 6, 4, '', '- Keep this report with the results it was made from.'",
    "select 6, 5, '', '- Compare it with the next run.'",
    *[
        f"select 7, {i}, '', '{t}'" for i, t in enumerate(["", _DOUBLE_RULE, "(end)", _DOUBLE_RULE])
    ],
]
_REPORT = " union all ".join(_REPORT_PARTS)

_DESCRIBE = " union all ".join(
    [
        f"""select '{n}' as column_name, count({n}) as n, round(avg({n}), 6) as mean, round(stddev_samp({n}), 6) as stddev,
 min({n})::varchar as min_value, max({n})::varchar as max_value from features"""
        for n in (
            "response_time", "level_error", "level_warn", "level_info", "hour", "minute",
            "message_length", "has_error_keyword", "suspicious_ip", "high_response_time",
            "very_high_response_time",
        )
    ]
    + [
        f"""select '{n}', count({n}), null, null, min({n}), max({n}) from features"""
        for n in ("level", "service", "message", "ip_address", '"user"')
    ]
).replace("'\"user\"'", "'user'")

_GRAPH_ROWS = """select 'node' as kind, id as a, type as b, null::bigint as weight from named_nodes
 union all select 'link', source, target, value from links"""

_SHOWN = "(select id from named_nodes order by id, type limit 150)"
_GRAPH_PREVIEW = f"""select 'node' as kind, (row_number() over (order by id, type) - 1)::int as place, id as a, type as b, null::bigint as weight
 from named_nodes qualify place < 150
 union all
 select 'link', (row_number() over (order by value desc, source, target) - 1)::int as place, source, target, value
 from links where source in {_SHOWN} and target in {_SHOWN} qualify place < 300"""

_COUNTS = """select count(*) as total_logs, count(*) filter (s > 0.6::double) as total_anomalies,
 count(*) filter (s > 0.8::double) as critical_alerts,
 round(coalesce(count(*) filter (s > 0.6::double) / count(*), 0), 6) as anomaly_rate"""

_VOLUMES = """count(*) as total_logs, count(*) filter (enhanced > 0.4::double) as anomalies_found,
 count(*) filter (enhanced >= 0.9::double) as critical_alerts,
 count(*) filter (enhanced >= 0.7::double and enhanced < 0.9::double) as high_risk_alerts,
 count(*) filter (enhanced >= 0.5::double and enhanced < 0.7::double) as medium_risk_alerts,
 count(*) filter (enhanced > 0.4::double and enhanced < 0.5::double) as low_risk_alerts,
 count(*) filter (level = 'ERROR') as error_logs, count(*) filter (level = 'WARN') as warn_logs,
 round(avg(response_time), 6) as avg_response_time, max(response_time) as max_response_time,
 """ + f"""strftime(min(timestamp), {_TS}) as start_time, strftime(max(timestamp), {_TS}) as end_time"""

_ENHANCED_STATS = f"""select {_VOLUMES},
 (select string_agg(ip_address, ',' order by n desc, ip_address) from (
   select ip_address, count(*) as n from valid group by ip_address order by n desc, ip_address limit 10)) as top_ips
 from enhanced"""

_ENHANCED_BY_FILE = f"""select * from (select file_id, {_VOLUMES} from enhanced group by file_id) join (
 select file_id, string_agg(ip_address, ',' order by n desc, ip_address) as top_ips from (
   select file_id, ip_address, count(*) as n from valid group by file_id, ip_address
   qualify row_number() over (partition by file_id order by n desc, ip_address) <= 10) group by file_id) using (file_id)"""

_BODIES: dict[str, str] = {
    "parse_lines": f"select {_PARSED} from parsed",
    "valid_lines": f"select {_PARSED} from valid",
    "features": """select file_id, line_number, response_time, level_error, level_warn, level_info, hour, minute,
 message_length, has_error_keyword, suspicious_ip, high_response_time, very_high_response_time from all_features""",
    "rejected_lines": "select file_id, line_number, level, service from valid where response_time is null",
    "render_lines": f"""select file_id, line_number, strftime(timestamp, {_TS}) || ' [' || level || '] ' || service || ' - ' || message
 || ' | IP: ' || ip_address || ' | User: ' || "user" || ' | ResponseTime: ' || response_time || 'ms' as value from valid""",
    "pattern_score": "select file_id, line_number, round(anomaly_score, 6) as anomaly_score from scored",
    "pattern_anomalies": f"select {_PARSED}, round(anomaly_score, 6) as anomaly_score from anomalies",
    "severity": """select file_id, line_number, severity,
 case severity when 'critical' then 1 when 'high' then 2 when 'medium' then 3 else 4 end as priority from labelled""",
    "alerts": f"select {_ALERT} from alert_rows",
    "error_patterns": """select message as pattern, count(*) as error_count from anomalies
 where level = 'ERROR' group by 1""",
    "distinct_entities": """select distinct 'service' as kind, service as entity from anomalies where service <> ''
 union all select distinct 'ip_address', ip_address from anomalies where ip_address <> ''""",
    "entities_by_file": f"""select file_id, strftime(timestamp, '%Y-%m-%d') as day, kind, entity, {_SEEN} from listed where entity <> '' group by 1, 2, 3, 4""",
    "entity_totals": f"select kind, entity, {_SEEN} from listed where entity <> '' group by 1, 2",
    "error_patterns_by_file": f"""select file_id, strftime(timestamp, '%Y-%m-%d') as day, message as pattern, {_SEEN}
 from anomalies where level = 'ERROR' group by 1, 2, 3""",
    "stored_list_sizes": f"""select *, services_count as recorded_services_count, suspicious_ips_count as recorded_suspicious_ips_count,
 error_patterns_count as recorded_error_patterns_count from (select file_id, services_count, suspicious_ips_count, error_patterns_count
 from (select file_id, {_STATS} from scored group by file_id))""",
    "first_last": f"""select strftime(arg_min(timestamp, line_number), {_TS}) as first_timestamp,
 strftime(arg_max(timestamp, line_number), {_TS}) as last_timestamp from anomalies where timestamp is not null""",
    "tumbling_service": _windows(_TUMBLING),
    "sliding_service": _windows(_SLIDING),
    "timeline_minute": f"""select strftime(date_trunc('minute', timestamp), {_TS}) as minute, count(*) as anomaly_count
 from anomalies where timestamp is not null group by 1""",
    "timeline_hour": f"""select strftime(date_trunc('hour', timestamp), {_TS}) as hour, count(*) as anomaly_count, {_BANDS}
 from anomalies where timestamp is not null and level <> '' and service <> '' group by 1""",
    "service_trend": """select service, sum(level_error)::bigint as error_count, sum(level_warn)::bigint as warn_count,
 round(avg(response_time), 6) as avg_response_time from features group by service""",
    "service_counts": "select service, count(*) as log_count from valid group by service",
    "log_totals": """select count(*) as total_logs, count(*) filter (level = 'ERROR') as error_logs,
 count(*) filter (level = 'WARN') as warn_logs, round(avg(response_time), 6) as avg_response_time,
 max(response_time) as max_response_time from valid""",
    "top_ips": "select ip_address, count(*) as log_count from valid group by 1 order by 2 desc, 1 limit 10",
    "time_range": f"""select strftime(min(timestamp), {_TS}) as start_time, strftime(max(timestamp), {_TS}) as end_time from valid""",
    "describe": _DESCRIBE,
    "severity_counts": f"select {_BANDS} from anomalies",
    "alert_counts": """select count(*) filter (severity = 'CRITICAL') as critical_alerts,
 count(*) filter (severity = 'HIGH') as high_risk_alerts, count(*) filter (severity = 'MEDIUM') as medium_risk_alerts,
 count(*) filter (severity not in ('CRITICAL', 'HIGH', 'MEDIUM')) as low_risk_alerts from alert_rows""",
    "service_dist": "select service, count(*) as anomaly_count from anomalies group by service",
    "severity_dist": """select s.severity, count(a.severity) as anomaly_count
 from (values ('critical'), ('high'), ('medium'), ('low')) s(severity) left join anomalies a using (severity) group by 1""",
    "top_anomalous_ips": "select ip_address, count(*) as anomaly_count from anomalies group by 1 order by 2 desc, 1 limit 10",
    "summary_rates": f"""select file_id, round(100.0::double * anomalies_found / greatest(total_logs, 1), 2) as anomaly_rate,
 round(100.0::double * critical_alerts / greatest(anomalies_found, 1), 2) as critical_rate,
 services_count, suspicious_ips_count, error_patterns_count
 from (select file_id, {_STATS} from scored group by file_id)""",
    "analysis_statistics": f"""select {_STATS},
 strftime(arg_min(timestamp, line_number) filter (anomaly_score >= 0.4::double and timestamp is not null), {_TS}) as first_timestamp,
 strftime(arg_max(timestamp, line_number) filter (anomaly_score >= 0.4::double and timestamp is not null), {_TS}) as last_timestamp
 from scored""",
    "file_totals": """select count(*) as total_files, count(*) as successful, 0::bigint as failed, sum(n)::bigint as total_anomalies
 from (select file_id, count(*) filter (anomaly_score >= 0.4::double) as n from scored group by file_id)""",
    "graph_vertices": "select id, type from vertices",
    "graph_edges": f"select {_EDGE} from edges",
    "vertex_counts": "select type, count(*) as vertex_count from vertices group by type",
    "graph_size": "select (select count(*) from edges) as edge_count, (select count(*) from vertices) as vertex_count",
    "out_degree": "select src as node_id, count(*) as out_degree, sum(weight)::bigint as total_interactions from edges group by 1",
    "in_degree": "select dst as node_id, count(*) as in_degree, sum(weight)::bigint as total_incoming from edges group by 1",
    "node_stats": f"select {_NODE} from nodes",
    "node_scores": f"select {_NODE_SCORE} from scored_nodes",
    "suspicious_nodes": f"select {_NODE_SCORE} from scored_nodes where graph_anomaly_score > 0.6::double",
    "edge_scores": f"""select {_EDGE}, case when error_count > 5 then 0.9::double when avg_response_time > 2000 then 0.8::double
 when error_count > 2 then 0.6::double else 0.2::double end as edge_anomaly_score from edges""",
    "suspicious_ips": "select id, graph_anomaly_score, out_degree from bad_ips",
    "suspicious_connections": "select * from connections",
    "targeted_services": """select target_service, count(*) as attack_count, sum(error_count)::bigint as total_errors,
 round(avg(graph_anomaly_score), 6) as avg_anomaly_score from connections group by 1""",
    "top_edges": f"select {_EDGE} from edges order by weight desc, src, dst limit 10",
    "graph_links": "select source, target, value from links",
    "skipped_links": f"""select {_EDGE} from all_edges
 where src not in (select id from named_nodes) or dst not in (select id from named_nodes)""",
    "graph_json": _GRAPH_ROWS,
    "graph_preview": _GRAPH_PREVIEW,
    "anomaly_page": _page(_RECORD, "anomalies", "file_id, line_number", 2, 50),
    "min_score_page": _page(
        _RECORD, "anomalies", "file_id, line_number", 1, 50,
        "anomaly_score >= 0.6::double and service = 'auth-service'",
    ),
    "alert_page": _page(_ALERT, "alert_rows", _ALERT_ORDER, 2, 20),
    "critical_alert_page": _page(_ALERT, "alert_rows", _ALERT_ORDER, 1, 20, "severity = 'CRITICAL'"),
    "annotated_lines": _VIEW,
    "log_view": _page("*", f"({_VIEW})", "file_id, line_number", 3, 100),
    "anomalous_log_view": _page("*", f"({_VIEW})", "file_id, line_number", 1, 100, "is_anomaly"),
    "recent_anomalies": f"select {_RECORD} from ({_RECENT})",
    "recent_timeline": f"""select strftime(date_trunc('minute', timestamp), {_TS}) as minute, count(*) as anomaly_count
 from ({_RECENT}) where timestamp is not null group by 1""",
    "recent_service_dist": f"select service, count(*) as anomaly_count from ({_RECENT}) group by 1",
    "live_counters": f"{_COUNTS} from (select anomaly_score as s from scored where level <> '' and service <> '')",
    "analysis_list": f"""select file_id, file_id as filename, 'completed' as status, total_logs, anomalies_found, critical_alerts
 from (select file_id, {_STATS} from scored group by file_id)""",
    "analysis_result": f"""select file_id, total_logs, anomalies_found, anomalies_found as anomalies_count,
 {_ALERT_SUM} as alerts_count, 'completed' as status
 from (select file_id, {_STATS} from scored group by file_id) order by file_id limit 1""",
    "report_lines": f"select section, ord::bigint as ord, detail, line from ({_REPORT})",
    "report_text": f"select line as value, count(*) as n from ({_REPORT}) group by line",
    "scaled_features": "select file_id, line_number, "
    + ", ".join(f"round(z_{n}, 6) as z_{n}" for n in _FEATURES)
    + " from scaled where response_time is not null",
    "distance_fixed_centers": """select file_id, line_number, cluster, round(distance_to_center, 6) as distance_to_center from assigned""",
    "distance_stats_fixed_centers": """select round(max_distance, 6) as max_distance, round(avg_distance, 6) as avg_distance,
 round(stddev_distance, 6) as stddev_distance from distances""",
    "zscore_fixed_centers": """select file_id, line_number, round(s, 6) as anomaly_score, (s > 0.7::double)::int as is_anomaly from (
 select file_id, line_number, greatest(0, least(1, ((distance_to_center - avg_distance) / stddev_distance + 3) / 6)) as s
 from assigned cross join distances where cluster is not null)""",
    "linear_score": "select file_id, line_number, round(base, 6) as anomaly_score from linear",
    "enhanced_score": "select file_id, line_number, round(enhanced, 6) as anomaly_score from enhanced",
    "enhanced_score_by_id": """select file_id, line_number,
 round(least(base + case when cluster >= 3 then 0.2::double else 0 end + slow_part + service_part + ip_part, 1), 6) as anomaly_score
 from boosted""",
    "trained_statistics": _ENHANCED_STATS,
    "trained_statistics_by_file": _ENHANCED_BY_FILE,
    "isolation_fixed_forest": f"""select file_id, line_number,
 case when response_time is not null then round({_ISOLATION}, 6) end as isolation_score from features""",
    "ensemble_fixed": """select file_id, line_number, round(kmeans_score, 6) as anomaly_score, round(isolation_score, 6) as isolation_score,
 round(final_score, 6) as final_anomaly_score, (kmeans_score > 0.7::double)::int as is_anomaly, (final_score >= 0.65::double)::int as is_anomaly_final from combined""",
    "ensemble_fixed_counts": "select (final_score >= 0.65::double)::int as is_anomaly_final, count(*) as log_count from combined group by 1",
    "analyze_ml_fixed": f"""select {_PARSED}, round(final_score, 6) as anomaly_score, 'spark_mllib' as analysis_type, cluster
 from combined where final_score >= 0.65::double""",
    "kmeans_invariants": "select count(*) as scored_rows, 0::bigint as nearer_elsewhere, 0::bigint as shares_off, 5::bigint as centers from complete",
    "contamination_sketch": "select count(*) as lines, true as at_least_the_share, true as no_more_above from complete",
    "model_roundtrip": "select count(*) - count(*) as differing_rows from log_lines",
    "pipeline_agreement": "select count(*) as scored_rows, 0::bigint as differing_rows from complete",
    "ml_line_counts": """select count(*) filter (response_time is not null and timestamp is not null) as scored_lines,
 count(*) filter (response_time is not null and timestamp is not null) as scores_in_range,
 count(*) filter (response_time is null or timestamp is null) as rejected_lines from valid""",
    "analyze_rules": f"select {_RECORD} from anomalies",
    "analyze_trained_fixed_centers": f"""select {_PARSED}, round(enhanced, 6) as anomaly_score, 'spark_mllib' as analysis_type, cluster
 from enhanced where enhanced > 0.4::double""",
    "result_tables": f"select {_RECORD} from anomalies",
    "text_scan": "select value from log_lines",
    "multi_file": """select file, count(*) as valid_lines, count(*) filter (level = 'ERROR') as error_lines
 from rotated_valid group by file""",
    "line_counts": "select file as file_id, count(*) as line_count from rotated group by file",
    "line_numbers": """select file, row_number() over (partition by file order by line_number) as line_number, value from rotated""",
    "batch_directory": """select count(distinct file) + (select count(*) from spoiled) as total_files, count(distinct file) as successful,
 (select count(*) from spoiled) as failed, (select count(*) from enhanced where enhanced > 0.4::double) as total_anomalies from rotated_valid""",
    "file_identity": "select file, 1::bigint as identities, true as well_formed, count(*) as line_count from rotated group by file",
    "file_sizes": "select file, sum(strlen(value) + 1)::bigint as length from rotated group by file",
    "stream_detect": f"""select {_ts()}, level, service, message, ip_address, "user", response_time,
 round(base, 6) as anomaly_score from linear where base > 0.6::double""",
    "stream_statistics": f"""{_COUNTS}, count(distinct service) filter (s > 0.6::double) as services_affected,
 count(distinct ip_address) filter (s > 0.6::double) as suspicious_ips
 from (select base as s, service, ip_address from linear)""",
    "running_counters": f"{_COUNTS} from (select base as s from linear)",
    "stream_sliding": _windows(_SLIDING),
    "stream_graph": "select src as source, dst as target, weight as value from edges",
    "stream_windows": _windows(_TUMBLING),
}

ORACLES: dict[str, str] = {name: _sql(body) for name, body in _BODIES.items()}
