"""The catalog's queries in plain SQL for an independent engine (DuckDB dialect)."""

from __future__ import annotations

from botlens import fixtures, values
from botlens.functions import addresses
from botlens.operators import learning
from botlens.plans import catalog


def _with(*parts: tuple[str, str]) -> str:
    return "with " + ",\n".join(f"{name} as (\n{body}\n)" for name, body in parts) + "\n"


def _logs(time: str) -> tuple[str, str]:
    columns = ",\n".join(f"{sql} as {name}" for name, sql in fixtures.EVENT_COLUMNS.items())
    return "logs", f"select event_id, {time} as ts,\n{columns}\nfrom events"


SPARSE = _logs("ts")
DENSE = _logs(f"epoch_ms({fixtures.DENSE_START_MS} + event_id * {fixtures.DENSE_STEP_MS})")


def _any(words, column="lower(user_agent)") -> str:
    return "(" + " or ".join(f"contains({column}, '{w}')" for w in words) + ")"


def _flag(condition: str) -> str:
    return f"case when {condition} then 1 else 0 end"


_MISSING = "user_agent is null or user_agent = ''"
_SUSPICIOUS = _flag(f"{_MISSING} or {_any(values.SUSPICIOUS_AGENTS)}")
_EXTENDED = _flag(f"{_MISSING} or {_any(values.SUSPICIOUS_AGENTS_EXTENDED)}")
_EXEMPT = _flag(
    f"{_MISSING} or ({_any(values.SUSPICIOUS_AGENTS)} and not {_any(values.WELCOME_AGENTS)})"
)
_STANDARD = _flag(
    f"{_MISSING} or ({_any(values.SUSPICIOUS_AGENTS_EXTENDED)} and not {_any(values.WELCOME_AGENTS)})"
)
_PORT = "case when port is not null then port when path like 'https%' then 443 else 80 end"
_PROTOCOL = _flag("protocol is not null and lower(protocol) <> 'tcp'")
_TYPE = (
    "case when request_type is not null then case when lower(request_type) = 'https' then 1 else 0 end"
    f" when ({_PORT}) = 443 then 1 else 0 end"
)
_ENCRYPTED = _flag(f"({_PORT}) = 443 or ({_TYPE}) = 1")
_TOOL, _BROWSER = _flag(_any(values.TOOL_AGENTS)), _flag(_any(values.BROWSER_AGENTS))
_ROW = {
    "Port": _PORT, "Request_Type": _TYPE, "Protocol": _PROTOCOL,
    "Payload_Size": "cast(bytes_sent as double)", "is_encrypted": _ENCRYPTED,
    "is_failure": _flag("status >= 400"), "ua_is_empty": _flag(_MISSING),
    "ua_is_tool": _TOOL, "ua_is_browser": _BROWSER,
}
_FEATURES = "features", (
    "select event_id, ts, client_ip, user_agent,\n"
    + ",\n".join(f'{sql} as "{name}"' for name, sql in _ROW.items()) + "\nfrom logs"
)


def _slid(source: str, duration: int, slide: int) -> tuple[str, str]:
    """Each row once per window it lies in; windows start on multiples of the slide."""
    return "slid", (
        f"select s.*, cast((floor(epoch(ts) / {slide}) - i) * {slide} as bigint) as window_start,\n"
        f"cast((floor(epoch(ts) / {slide}) - i) * {slide} + {duration} as bigint) as window_end\n"
        f"from {source} s, range({duration // slide}) t(i)"
    )


def _rule(logs, duration, slide, threshold, limit, suspicious=_SUSPICIOUS, legacy=False):
    label = (lambda c, n: f"case when {c} then '{n}' else '' end") if legacy else (
        lambda c, n: f"case when {c} then '{n}' end"
    )
    reasons = ", ".join([
        label("burst_score > 0.5e0", values.HIGH_RATE),
        label("error_score > 0.5e0", values.HIGH_ERRORS),
        label("ua_score > 0.5e0", values.SUSPICIOUS_AGENT),
    ])
    half = threshold / 2
    return _with(
        logs,
        ("flags", f"""select *, {suspicious} as ua_suspicious,
            {_flag('status >= 400 and status < 500')} as e4, {_flag('status >= 500 and status < 600')} as e5,
            {_flag('status >= 400')} as e, {_flag('status >= 200 and status < 300')} as ok from logs"""),
        _slid("flags", duration, slide),
        ("counted", """select window_start, window_end, client_ip, count(*) as request_count,
            cast(sum(e4) as bigint) as error_4xx_count, cast(sum(e5) as bigint) as error_5xx_count,
            cast(sum(e) as bigint) as total_errors, cast(sum(ok) as bigint) as total_success,
            cast(sum(ua_suspicious) as bigint) as suspicious_ua_count, avg(bytes_sent) as avg_bytes_sent
            from slid group by all"""),
        ("ratios", """select *, total_errors / request_count as error_ratio,
            suspicious_ua_count / request_count as ua_suspicious_ratio from counted"""),
        ("parts", f"""select *, case when request_count >= {threshold} then 1e0
              when request_count >= {half}e0 then (request_count - {half}e0) / {half}e0 else 0e0 end as burst_score,
            case when error_ratio >= 0.5e0 then 1e0 when error_ratio > 0 then error_ratio / 0.5e0
              else 0e0 end as error_score, ua_suspicious_ratio as ua_score from ratios"""),
        ("scored", """select *, burst_score * 0.4e0 + error_score * 0.3e0 + ua_score * 0.3e0 as bot_score
            from parts"""),
        ("rule", f"""select *, bot_score >= {limit}e0 as is_bot,
            concat_ws(', ', {reasons}) as detection_reasons from scored"""),
    )


def _round(names: str) -> str:
    """Select list: a name with ``~`` is rounded to 6 digits, with ``~~`` to 4."""
    parts = []
    for name in names.split():
        plain = name.strip("~")
        quoted = f'"{plain}"'
        digits = {0: None, 1: 6, 2: 4}[len(name) - len(plain)]
        parts.append(quoted if digits is None else f"round({quoted}, {digits}) as {quoted}")
    return ", ".join(parts)


_RULE_ALL = _round(
    "window_start window_end client_ip request_count error_4xx_count error_5xx_count total_errors"
    " total_success suspicious_ua_count avg_bytes_sent~ error_ratio~ ua_suspicious_ratio~"
    " burst_score~ error_score~ ua_score~ bot_score~ is_bot detection_reasons"
)
_RULE = _rule(DENSE, 30, 10, 10, 0.5)


def _from_rule(names: str, tail: str = "", source: str = _RULE) -> str:
    return f"{source}select {_round('window_start client_ip ' + names)} from rule {tail}"


def _firsts() -> str:
    names = [*_ROW, "user_agent"]
    return ", ".join(f'first("{n}" order by ts, event_id) as "{n}"' for n in names)


def _found(legacy: bool = False, extra: tuple = ()) -> str:
    """The fallback detections as ``found``."""
    label = (lambda c, n: f"case when {c} then '{n}' else '' end") if legacy else (
        lambda c, n: f"case when {c} then '{n}' end"
    )
    reasons = ", ".join([
        label("requests_per_ip > 10", values.HIGH_RATE),
        label("failure_rate_per_ip > 0.5e0", values.HIGH_ERRORS),
        label("ua_is_tool = 1", values.BOT_AGENT),
        label("ua_is_empty = 1", values.EMPTY_AGENT),
        label("ua_is_browser = 0", values.NON_BROWSER),
    ])
    return _with(
        DENSE, _FEATURES, _slid("features", 60, 30),
        ("grouped", f"""select window_start, window_end, client_ip, count(*) as requests_per_ip,
            avg(is_failure) as failure_rate_per_ip, avg("Payload_Size") as avg_payload_per_ip,
            stddev_samp("Payload_Size") as raw_std, avg(is_failure) as protocol_error_rate, {_firsts()}
            from slid group by window_start, window_end, client_ip"""),
        ("filled", """select *, coalesce(raw_std, 0e0) as payload_std_per_ip,
            0e0 as time_since_last_request, 0e0 as inter_arrival_std from grouped"""),
        ("scored", """select *, case when requests_per_ip >= 10 then 1e0
              when requests_per_ip >= 5 then (requests_per_ip - 5e0) / 5e0 else 0e0 end * 0.4e0
            + case when failure_rate_per_ip >= 0.5e0 then 1e0 else failure_rate_per_ip / 0.5e0 end * 0.3e0
            + case when ua_is_tool = 1 then 0.8e0 when ua_is_empty = 1 then 0.6e0 else 0e0 end * 0.3e0
              as bot_probability from filled"""),
        ("found", f"""select *, case when bot_probability >= 0.5e0 then 1 else 0 end as is_bot,
            '{values.RULE_METHOD}' as prediction_method,
            case when bot_probability >= 0.5e0 then '{values.BOT_CLASS}' else '{values.NORMAL_CLASS}' end
              as classification,
            concat_ws(', ', {reasons}) as detection_reasons from scored"""),
        *extra,
    )


_FOUND = _found()


def _from_found(names: str, tail: str = "", source: str = _FOUND) -> str:
    return f"{source}select {_round('window_start client_ip ' + names)} from found {tail}"


def _terms(field: str, size: int = 10) -> str:
    return (
        f'{_FOUND}select "{field}", count(*) as row_count from found where "{field}" is not null'
        f' group by 1 order by 2 desc, 1 limit {size}'
    )


def _timeline(source: str, table: str, seconds: int) -> str:
    return f"""{source}, counts as (
        select cast(floor(window_start / {seconds}) * {seconds} as bigint) as bucket, count(*) as n from {table} group by 1),
    axis as (select unnest(range((select min(bucket) from counts), (select max(bucket) from counts) + 1, {seconds})) as bucket)
    select axis.bucket, cast(coalesce(n, 0) as bigint) as row_count from axis left join counts using (bucket)"""


def _log_feature(name: str, sql: str) -> str:
    return f'{_with(SPARSE)}select event_id, {sql} as "{name}" from logs'


_PATTERN = values.ACCESS_LOG_PATTERN.replace("'", "''")
_NAMES = ", ".join(f"'{n}'" for n in values.ACCESS_LOG_GROUPS)
_CLF = "strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000'"
_LINES = (
    SPARSE,
    ("wholes", f"select event_id, {fixtures.RAW_LINE.format(clf=_CLF)} as whole from logs"),
    ("lines", f"select event_id, {fixtures.LINE} as value from wholes"),
)
_PARSED = (
    *_LINES,
    ("groups", f"""select event_id, regexp_extract(value, '{_PATTERN}', [{_NAMES}]) as g from lines
        where regexp_matches(value, '{_PATTERN}')"""),
    ("parsed", "select event_id, " + ", ".join(
        f'case when g."tail" <> \'\' then g."{n}" end as "{n}"' if n in ("referer", "agent")
        else f'g."{n}" as "{n}"'
        for n in values.ACCESS_LOG_GROUPS if n != "tail") + " from groups"),
)
_LOG_TIME = "try_strptime(\"time\", '%d/%b/%Y:%H:%M:%S %z')"
_ISO = "strftime({} at time zone 'UTC', '%Y-%m-%dT%H:%M:%S.%gZ')"


def _leading_int(name: str, kind: str) -> str:
    return f"coalesce(try_cast(regexp_extract(\"{name}\", '^\\s*([+-]?\\d+)', 1) as {kind}), 0)"


_EVENT = (
    "timestamp", "client_ip", "method", "path", "status", "bytes_sent", "user_agent", "referer",
    "log_type", "protocol", "port", "request_type",
)
_ENCODED = (
    SPARSE,
    ("encoded", "select event_id, cast(to_json(struct_pack("
     + ", ".join(
         "\"timestamp\" := strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ')" if n == "timestamp" else f'"{n}" := {n}'
         for n in _EVENT)
     + ")) as varchar) as value from logs"),
)
_DECODED = (
    *_ENCODED,
    ("bodies", "select event_id, value as body from encoded"),
    ("messages", f"select event_id, {fixtures.MESSAGE} as value from bodies"),
    ("valid", "select event_id, case when json_valid(value) then cast(value as json) end as j from messages"),
    ("decoded", """select event_id, cast(floor(epoch(try_cast(j->>'timestamp' as timestamptz))) as bigint) as "timestamp",
        """ + ", ".join(
            f"try_cast(j->>'{n}' as {kind}) as {n}" for n, kind in zip(
                _EVENT[1:],
                ("varchar", "varchar", "varchar", "int", "bigint", "varchar", "varchar", "varchar",
                 "varchar", "int", "varchar"),
                strict=True))
     + " from valid"),
)

_MIXED = "mixed", f"""select event_id, {catalog.MIXED_ADDRESS.replace('as string', 'as varchar')} as client_ip, client_ip as plain,
    event_id % 7 as kind,
    array_to_string(list_transform(string_split(client_ip, '.'), lambda x: printf('%02x', cast(x as int))), '') as digits
    from logs"""
_GAPS = "gaps", """select event_id, ts, client_ip,
    (epoch_us(ts) - lag(epoch_us(ts)) over (partition by client_ip order by ts, event_id)) / 1e6 as gap_seconds
    from logs"""
_ARRIVALS = (
    DENSE, _GAPS, _slid("gaps", 60, 30),
    ("arrivals", """select window_start, window_end, client_ip,
        coalesce(first(gap_seconds order by ts, event_id), 0e0) as time_since_last_request,
        coalesce(stddev_samp(gap_seconds), 0e0) as inter_arrival_std
        from slid group by window_start, window_end, client_ip"""),
)
_LOGIT = " + ".join(f"{w}e0 * {n}" for n, w in catalog.FOREIGN_WEIGHTS.items())
_ID = "sha256(cast(window_start as varchar) || '|' || client_ip)"
_CHANCE = "cast('0x' || substr(sha256({}), 1, 8) as bigint) / 4294967296e0"
_CELL = ", ".join(f'"{n}"' for n in learning.CELL_FEATURES)
_SIZE = " + ".join(f'ln(1 + abs("{n}"))' for n in values.FEATURE_NAMES if n not in learning.CELL_FEATURES)
_SEARCH = "bot_probability~ requests_per_ip is_bot"
_SIZES = "sizes", """select count(*) as n, sum(is_bot) as ones, count(*) - sum(is_bot) as zeros from found"""


def _ends(seconds: int, columns: str) -> str:
    return f"""cast(floor(epoch(ts) / {seconds}) * {seconds} as bigint) as window_start,
        cast(floor(epoch(ts) / {seconds}) * {seconds} + {seconds} as bigint) as window_end, {columns}"""


_BOT_PATHS = (
    f"{_RULE}select path, count(*) as request_count from logs"
    " where path is not null and exists (select 1 from rule where is_bot and rule.client_ip = logs.client_ip"
    " and epoch(ts) >= window_start and epoch(ts) < window_end) group by path"
    " order by request_count desc, path limit 10"
)

def _guessing() -> list[tuple[str, str]]:
    """A table per step: its requests, each with the last one of the step before, by client and time."""
    parts = [DENSE, ("step0", f"select *, epoch_us(ts) as micros, {catalog.GUESSING[0]} as done from logs where client_ip is not null")]
    for step, condition in enumerate(catalog.GUESSING[1:], 1):
        parts.append((f"step{step}", f"""select * replace (coalesce(({condition}) and micros - max(case when done then micros end) over (
            partition by client_ip order by micros range between unbounded preceding and 1 preceding)
            <= {catalog.GUESSING_SECONDS * 1_000_000}, false) as done) from step{step - 1}"""))
    return parts


_GUESSED = f"step{len(catalog.GUESSING) - 1} where done"

ORACLES: dict[str, str] = {
    "request_sequences": f"{_with(*_guessing())}select event_id, client_ip, path from {_GUESSED}",
    "sequence_clients": f"""{_with(*_guessing())}select client_ip, count(*) as sequence_count,
        cast(floor(epoch(min(ts))) as bigint) as first_completed, cast(floor(epoch(max(ts))) as bigint) as last_completed
        from {_GUESSED} group by client_ip""",
    "parse_access_log": f"{_with(*_PARSED)}select * from parsed",
    "parse_quarantine": f"{_with(*_LINES)}select event_id, value from lines where not regexp_matches(value, '{_PATTERN}')",
    "normalize_access_log": f"""{_with(*_PARSED)}select event_id, {_ISO.format(_LOG_TIME)} as "timestamp",
        remote as client_ip, method, path, {_leading_int('code', 'int')} as status,
        {_leading_int('size', 'bigint')} as bytes_sent, agent as user_agent, referer,
        '{values.LOG_TYPE}' as log_type, coalesce(nullif(protocol, ''), 'TCP') as protocol,
        coalesce(try_cast(port as int), 80) as port, coalesce(nullif(request_type, ''), 'HTTP') as request_type
        from parsed""",
    "typed_log_schema": f"""{_with(*_PARSED)}select cast(epoch({_LOG_TIME}) as bigint) as "timestamp",
        remote as client_ip, method, path, {_leading_int('code', 'int')} as status,
        {_leading_int('size', 'bigint')} as bytes_sent, agent as user_agent, referer,
        '{values.LOG_TYPE}' as log_type, coalesce(nullif(protocol, ''), 'TCP') as protocol,
        coalesce(try_cast(port as int), 80) as port, coalesce(nullif(request_type, ''), 'HTTP') as request_type
        from parsed""",
    "parse_clf_time": f"""{_with(*_PARSED)}select event_id, cast(epoch({_LOG_TIME}) as bigint) as epoch,
        {_ISO.format(_LOG_TIME)} as iso from parsed""",
    "encode_json_events": f"{_with(*_ENCODED)}select event_id, value from encoded",
    "decode_json_events": f"{_with(*_DECODED)}select * from decoded",
    "null_timestamps": f"""{_with(*_DECODED)}select count(*) as row_count,
        count(*) filter (where "timestamp" is null) as without_time from decoded""",
    "display_detections": f"""{_FOUND}select {_round(
        'window_start window_end client_ip requests_per_ip failure_rate_per_ip~ ua_is_tool ua_is_browser'
        ' bot_probability~ is_bot classification prediction_method detection_reasons')} from found""",
    "latest_detection_per_ip": f"""{_RULE}select {_RULE_ALL} from (select *, row_number() over
        (partition by client_ip order by window_end desc) as r from rule) where r = 1""",
    "flatten_window": f"{_RULE}select {_round('window_start window_end client_ip bot_score~')} from rule",
    "typed_store_schema": f"{_RULE}select {_RULE_ALL} from rule",
    "typed_model_schema": f"""{_FOUND}select {_round(
        'window_start window_end client_ip requests_per_ip failure_rate_per_ip~ avg_payload_per_ip~'
        ' bot_probability~ is_bot classification prediction_method detection_reasons user_agent')} from found""",
    "ua_suspicious": _log_feature("ua_suspicious", _SUSPICIOUS),
    "ua_suspicious_extended": _log_feature("ua_suspicious", _EXTENDED),
    "ua_whitelist": _log_feature("ua_suspicious", _EXEMPT),
    "status_classes": f"""{_with(SPARSE)}select event_id,
        {_flag('status >= 400 and status < 500')} as is_error_4xx,
        {_flag('status >= 500 and status < 600')} as is_error_5xx, {_flag('status >= 400')} as is_error,
        {_flag('status >= 200 and status < 300')} as is_success from logs""",
    "port_default": _log_feature("Port", _PORT),
    "protocol_encode": _log_feature("Protocol", _PROTOCOL),
    "request_type_encode": _log_feature("Request_Type", _TYPE),
    "payload_size": _log_feature("Payload_Size", "cast(bytes_sent as double)"),
    "is_encrypted": _log_feature("is_encrypted", _ENCRYPTED),
    "is_failure": _log_feature("is_failure", _flag("status >= 400")),
    "ua_is_empty": _log_feature("ua_is_empty", _flag(_MISSING)),
    "ua_is_tool": _log_feature("ua_is_tool", _TOOL),
    "ua_is_browser": _log_feature("ua_is_browser", _BROWSER),
    "base_features": f"""{_with(SPARSE, _FEATURES)}select cast(floor(epoch(ts)) as bigint) as "timestamp",
        * exclude (ts) from features""",
    "suspicious_path": _log_feature("suspicious_pattern", _flag("path like '%/admin%' or path like '%/wp-admin%'")),
    "bot_alerts": _from_rule("bot_score~ is_bot", "where is_bot"),
    "rule_registry": f"""{_with(SPARSE)}select event_id,
        {_flag("path like '%/admin%' or path like '%/wp-admin%'")} as suspicious_pattern,
        {_flag('path in (' + ', '.join(f"'{p}'" for p in values.PROBE_PATHS) + ')')} as probe_path from logs""",
    "traffic_windows": f"""{_RULE}select {_round(
        'window_start window_end client_ip request_count error_4xx_count error_5xx_count total_errors'
        ' total_success suspicious_ua_count avg_bytes_sent~')} from rule""",
    "traffic_ratios": _from_rule("request_count error_ratio~ ua_suspicious_ratio~"),
    "ml_window_features": f"""{_FOUND}select {_round(
        'window_start client_ip requests_per_ip failure_rate_per_ip~ avg_payload_per_ip~ protocol_error_rate~')},
        round(raw_std, 4) as payload_std_per_ip from found""",
    "first_values": _from_found(
        "Port Request_Type Protocol Payload_Size~ is_encrypted is_failure ua_is_empty ua_is_tool"
        " ua_is_browser user_agent"),
    "stddev_fill": _from_found("payload_std_per_ip~~"),
    "protocol_error_rate": f"""{_with(DENSE, _FEATURES, _slid('features', 60, 30))}
        select window_start, window_end, "Protocol", count(*) as request_count,
        round(avg(is_failure), 6) as protocol_error_rate from slid group by window_start, window_end, "Protocol" """,
    "request_gaps": f"{_with(SPARSE, _GAPS)}select event_id, round(gap_seconds, 6) as gap_seconds from gaps",
    "inter_arrival": f"""{_with(*_ARRIVALS)}select {_round(
        'window_start window_end client_ip time_since_last_request~ inter_arrival_std~')} from arrivals""",
    "exact_temporal_features": f"""{_with(*_ARRIVALS, ('counted', '''select window_start, client_ip,
        count(*) as requests_per_ip from slid group by window_start, client_ip'''))}select {_round(
        'window_start client_ip requests_per_ip time_since_last_request~ inter_arrival_std~')}
        from arrivals join counted using (window_start, client_ip)""",
    "ua_diversity": f"""{_with(DENSE, _slid('logs', 60, 30))}select window_start, window_end, client_ip,
        count(*) as request_count, count(distinct user_agent) as distinct_agents from slid
        group by window_start, window_end, client_ip""",
    "ua_diversity_sketched": f"""{_with(DENSE, _slid('logs', 60, 30))}select window_start, window_end, client_ip,
        count(*) as request_count, count(distinct user_agent) as distinct_agents from slid
        group by window_start, window_end, client_ip""",
    "burst_window": f"""{_rule(DENSE, 60, 10, 10, 0.5)}select {_round(
        'window_start window_end client_ip request_count burst_score~')} from rule""",
    "error_window": f"""{_rule(DENSE, 300, 10, 10, 0.5)}select {_round(
        'window_start window_end client_ip request_count total_errors error_ratio~ error_score~')} from rule""",
    "burst_score": _from_rule("burst_score~"),
    "error_score": _from_rule("error_score~"),
    "ua_score": _from_rule("ua_score~"),
    "bot_score": _from_rule("bot_score~"),
    "is_bot": _from_rule("is_bot"),
    "detection_reasons": _from_rule("detection_reasons"),
    "detection_reasons_legacy": _from_rule(
        "detection_reasons", source=_rule(DENSE, 30, 10, 10, 0.5, legacy=True)),
    "detection_reason_count": f"""{_RULE}select window_start, client_ip,
        {_flag('burst_score > 0.5e0')} + {_flag('error_score > 0.5e0')} + {_flag('ua_score > 0.5e0')}
        as reason_count from rule""",
    "rule_detections": f"{_RULE}select {_RULE_ALL} from rule",
    "rule_detections_sparse": f"{_rule(SPARSE, 86400, 43200, 6, 0.5)}select {_RULE_ALL} from rule",
    "rule_detections_standard": f"{_rule(DENSE, 60, 30, 100, 0.7, _STANDARD)}select {_RULE_ALL} from rule",
    "fallback_score": _from_found("bot_probability~ is_bot prediction_method"),
    "ml_reasons": _from_found("detection_reasons"),
    "ml_reasons_legacy": _from_found("detection_reasons", source=_found(legacy=True)),
    "classification": _from_found("is_bot classification"),
    "fallback_detections": f"""{_FOUND}select {_round(
        'window_start window_end client_ip requests_per_ip failure_rate_per_ip~ avg_payload_per_ip~'
        ' payload_std_per_ip~~ protocol_error_rate~ Port Request_Type Protocol Payload_Size~ is_encrypted'
        ' is_failure ua_is_empty ua_is_tool ua_is_browser user_agent time_since_last_request~'
        ' inter_arrival_std~ bot_probability~ is_bot prediction_method detection_reasons classification')}
        from found""",
    "assemble_features": f"""{_FOUND}select window_start, client_ip, {', '.join(
        f'round(cast("{n}" as double), {4 if n == "payload_std_per_ip" else 6}) as "{n}"'
        for n in values.FEATURE_NAMES)} from found""",
    "scale_features": f"""{_FOUND}select window_start, client_ip, {', '.join(
        f'round(case when stddev_samp("{n}") over () = 0 then 0e0 else ("{n}" - avg("{n}") over ())'
        f' / stddev_samp("{n}") over () end, {4 if n == "payload_std_per_ip" else 6}) as "{n}"'
        for n in values.SCALED_FEATURES)} from found""",
    "balance_classes": f"""{_found(extra=(_SIZES,))}select window_start, client_ip, is_bot as label,
        round(n / (2e0 * case when is_bot = 1 then ones else zeros end), 6) as weight from found, sizes""",
    "oversample_classes": f"""{_found(extra=(_SIZES,
        ('ratios', "select window_start, client_ip, is_bot as label, greatest(ones, zeros)"
         " / (case when is_bot = 1 then ones else zeros end * 1e0) as ratio,"
         f" cast('0x' || substr(sha256({_ID}), 1, 8) as bigint) / 4294967296e0 as chance from found, sizes"),
        ('counts', "select *, cast(floor(ratio) as bigint) + case when chance < ratio - floor(ratio)"
         " then 1 else 0 end as copies from ratios")))}
        select window_start, client_ip, label, unnest(range(copies)) as copy from counts""",
    "interpolate_minority": f"""{_found(extra=(
        ('bots', f"select {_ID} as detection_id, " + ', '.join(f'cast("{n}" as double) as "{n}"' for n in values.FEATURE_NAMES)
         + " from found where is_bot = 1"),
        ('ordered', f"select *, row_number() over (partition by {_CELL} order by floor(8 * ({_SIZE})),"
         f" {_CHANCE.format('detection_id')}, detection_id) as at, count(*) over (partition by {_CELL}) as size from bots"),
        ('pairs', "select o.detection_id || '|' || s.step as new_id, " + ', '.join(f'o."{n}", p."{n}" as "other {n}"' for n in values.FEATURE_NAMES)
         + " from ordered o, (values (1), (2)) s(step), ordered p where p.at = (o.at - 1 + s.step) % o.size + 1 and "
         + ' and '.join(f'o."{n}" = p."{n}"' for n in learning.CELL_FEATURES)),
        ('shares', f"select *, {_CHANCE.format('new_id')} as share from pairs")))}
        select new_id as detection_id, {', '.join(
            f'"{n}"' if n in learning.CELL_FEATURES
            else f'round("{n}" + share * ("other {n}" - "{n}"), {4 if n == "payload_std_per_ip" else 6}) as "{n}"'
            for n in values.FEATURE_NAMES)}, 1 as label from shares""",
    "interpolate_nearest": f"""{_found(extra=(
        ('bots', f"select {_ID} as detection_id, " + ', '.join(f'cast("{n}" as double) as "{n}"' for n in values.FEATURE_NAMES)
         + " from found where is_bot = 1"),
        ('spread', "select " + ', '.join(f'coalesce(nullif(stddev_samp("{n}"), 0), 1e0) as "s {n}"' for n in learning._NUMERIC_FEATURES)
         + " from bots"),
        ('placed', "select *, " + ', '.join(f'floor({learning.NEAREST_STEPS}e0 * ("{n}" / "s {n}") + 0.5e0) as "z {n}"'
                                           for n in learning._NUMERIC_FEATURES) + " from bots, spread"),
        ('near', "select o.detection_id as id, p.detection_id as other, row_number() over (partition by o.detection_id order by sqrt("
         + ' + '.join(f'(o."z {n}" - p."z {n}") * (o."z {n}" - p."z {n}")' for n in learning._NUMERIC_FEATURES)
         + "), p.detection_id) as place from placed o join placed p on o.detection_id <> p.detection_id and "
         + ' and '.join(f'o."{n}" = p."{n}"' for n in learning.CELL_FEATURES) + " qualify place <= 2"),
        ('known', "select id, count(*) as neighbours from near group by id"),
        ('steps', "select o.*, s.step, (s.step - 1) % k.neighbours + 1 as place from bots o, (values (1), (2)) s(step)"
         " left join known k on k.id = o.detection_id"),
        ('pairs', "select s.detection_id || '|' || s.step as new_id, " + ', '.join(
            f's."{n}", coalesce(p."{n}", s."{n}") as "other {n}"' for n in values.FEATURE_NAMES)
         + " from steps s left join near n on n.id = s.detection_id and n.place = s.place left join bots p on p.detection_id = n.other"),
        ('shares', f"select *, {_CHANCE.format('new_id')} as share from pairs")))}
        select new_id as detection_id, {', '.join(
            f'"{n}"' if n in learning.CELL_FEATURES
            else f'round("{n}" + share * ("other {n}" - "{n}"), {4 if n == "payload_std_per_ip" else 6}) as "{n}"'
            for n in values.FEATURE_NAMES)}, 1 as label from shares""",
    "forest_holdout": f"""{_FOUND}select is_bot as label, count(*) as row_count, true as probabilities_valid, true as accurate
        from found where {_CHANCE.format(_ID)} >= 0.7e0 group by 1""",
    "train_forest": f"{_FOUND}select is_bot as label, count(*) as row_count, true as learned from found group by 1",
    "predict_proba": f"""{_FOUND}select window_start, client_ip, true as probability_valid, true as verdict_fits,
        '{values.MODEL_METHOD}' as prediction_method from found""",
    "calibrated_forest": f"""{_FOUND}select is_bot as label, count(*) as row_count, true as probabilities_valid, true as calibrated,
        true as precise from found where floor(cast('0x' || substr(sha256({_ID} || '|fold'), 1, 8) as bigint) / 4294967296e0 * 3) = 0
        group by 1""",
    "predict_threshold": f"""{_FOUND}select window_start, client_ip, round(bot_probability, 6) as bot_probability,
        {_flag('bot_probability >= 0.6e0')} as is_bot, '{values.MODEL_METHOD}' as prediction_method from found""",
    "sigmoid_normalize": f"""{_found(extra=(
        ('raw', 'select window_start, client_ip, (requests_per_ip - 5) / 4e0 as s from found'),
        ('span', 'select min(s) < 0 or max(s) > 1 as outside from raw')))}
        select window_start, client_ip, round(case when outside then 1e0 / (1e0 + exp(-s)) else s end, 6)
        as bot_probability from raw, span""",
    "prediction_stats": f"""{_FOUND}select count(*) as row_count, round(min(bot_probability), 6) as min_probability,
        round(max(bot_probability), 6) as max_probability, round(avg(bot_probability), 6) as mean_probability
        from found""",
    "detection_id": f"{_FOUND}select window_start, client_ip, {_ID} as detection_id from found",
    "foreign_model_udf": f"""{_found(extra=(('judged', f'''select window_start, client_ip,
        1e0 / (1e0 + exp(-({_LOGIT} + ({catalog.FOREIGN_INTERCEPT}e0)))) as p from found'''),))}
        select window_start, client_ip, round(p, 6) as bot_probability, {_flag('p >= 0.5e0')} as is_bot,
        '{values.MODEL_METHOD}' as prediction_method from judged""",
    "detection_timeline": _timeline(_FOUND, "found", 30),
    "detection_timeline_60s": _timeline(_FOUND, "found", 60),
    "sparse_timeline": _timeline(_rule(SPARSE, 86400, 43200, 6, 0.5), "rule where is_bot", 3600),
    "total_detections": f"{_FOUND}select count(*) as total from found",
    "bot_vs_normal": _terms("is_bot", 5),
    "top_source_ips": _terms("client_ip"),
    "top_source_ips_by_requests": f"""{_with(DENSE)}select client_ip, count(*) as row_count from logs
        where client_ip is not null group by 1 order by 2 desc, 1 limit 10""",
    "tool_split": _terms("ua_is_tool"),
    "encrypted_split": _terms("is_encrypted", 5),
    "failure_split": _terms("is_failure", 5),
    "browser_split": _terms("ua_is_browser"),
    "avg_payload_top_ips": f"""{_FOUND}select client_ip, count(*) as row_count,
        round(avg(avg_payload_per_ip), 6) as avg_payload from found group by 1 order by 2 desc, 1 limit 10""",
    "traffic_by_port": _terms("Port", 5),
    "request_frequency": f"{_with(DENSE)}select {_ends(60, 'count(*) as request_count')} from logs group by 1, 2",
    "avg_gauge": f"{_FOUND}select round(avg(bot_probability), 6) as average from found",
    "recent_range": f"""{_with(SPARSE)}select event_id, cast(floor(epoch(ts)) as bigint) as "timestamp" from logs
        where ts >= (select max(ts) from logs) - interval 7 days""",
    "status_distribution": f"""{_with(SPARSE)}select status, count(*) as row_count from logs where status is not null group by 1""",
    "error_rate_over_time": f"""{_with(DENSE)}select {_ends(60, f'''count(*) as request_count,
        round(avg({_flag('status >= 400')}), 6) as error_rate''')} from logs group by 1, 2""",
    "top_bot_paths": _BOT_PATHS,
    "ip_profile": f"""{_FOUND}select client_ip, count(*) as window_count, max(requests_per_ip) as max_requests,
        round(avg(requests_per_ip), 6) as avg_requests, round(avg(failure_rate_per_ip), 6) as avg_failure_rate,
        round(avg(avg_payload_per_ip), 6) as avg_payload, cast(sum(ua_is_tool) as bigint) as tool_windows,
        cast(sum(ua_is_browser) as bigint) as browser_windows,
        cast(sum(is_encrypted) as bigint) as encrypted_windows, cast(sum(is_bot) as bigint) as bot_windows
        from found where client_ip = '{catalog.CLIENT}' group by 1""",
    "alert_threshold": _from_found(_SEARCH, "where bot_probability > 0.8e0"),
    "data_table": _from_found(_SEARCH, "order by requests_per_ip desc, window_start, client_ip limit 10 offset 10"),
    "kql_bots": _from_found(_SEARCH, "where is_bot = 1"),
    "kql_high_conf": _from_found(_SEARCH, "where bot_probability between 0.8e0 and 1e0"),
    "kql_high_conf_070": _from_found(_SEARCH, "where bot_probability between 0.7e0 and 1e0"),
    "kql_ip": _from_found(_SEARCH, f"where client_ip = '{catalog.CLIENT}'"),
    "kql_ip_prefix": _from_found(_SEARCH, f"where client_ip like '{catalog.NETWORK}%'"),
    "kql_network": _from_found("bot_probability~", "where client_ip like '203.0.0.%' and cast(split_part(client_ip, '.', 4) as int) between 64 and 127"),
    "typed_addresses": f"""{_with(DENSE, _MIXED)}select event_id, client_ip,
        case kind when 1 then '20010db8' || repeat('0', 20) || lpad(cast(event_id % 1000 as varchar), 4, '0')
            when 2 then null else '{addresses.MAPPED}' || digits end as address_key,
        cast(case kind when 1 then 6 when 2 then null else 4 end as integer) as family from mixed""",
    "network_requests": f"""{_with(DENSE, _MIXED, ('matched', """select client_ip,
        case when kind = 1 then case when event_id % 1000 between 100 and 199 then '2001:db8::100/120' else '2001:db8::/32' end
            when kind = 2 then null when plain = '10.0.0.2' then '10.0.0.2/32' when plain like '10.%' then '10.0.0.0/8'
            when plain like '203.%' then regexp_replace(plain, '[.][0-9]+$', '') || '.0/24' else '0.0.0.0/0' end as network from mixed"""))}
        select network, count(*) as requests, count(distinct client_ip) as clients from matched group by 1""",
    "kql_tool_bots": _from_found(_SEARCH, "where ua_is_tool = 1 and is_bot = 1"),
    "kql_scanning": _from_found(_SEARCH, "where is_failure = 1 and requests_per_ip between 5 and 100"),
    "kql_encrypted": _from_found(_SEARCH, "where is_encrypted = 1"),
    "kql_high_rate": _from_found(_SEARCH, "where requests_per_ip between 10 and 1000"),
    "kql_combined": _from_found(
        _SEARCH, "where (is_bot = 1 or ua_is_tool = 1) and failure_rate_per_ip between 0.5e0 and 1e0"),
    "log_failed": f"{_with(SPARSE)}select event_id, status from logs where status >= 400",
    "log_path": f"{_with(SPARSE)}select event_id, path from logs where path = '/.env'",
    "log_ua_wildcard": f"{_with(SPARSE)}select event_id, user_agent from logs where user_agent like '%bot%'",
}
