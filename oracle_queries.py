"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each string runs on DuckDB with the driver's tables registered as views. The
SQL re-derives everything from ``events`` independently of Spark: readings
projection, trailing windows (RANGE frames), metrics (UNION ALL), alerts and
reports. Texts and thresholds come from the same fixed-value modules as the
library so both sides state them once.
"""

from __future__ import annotations

from sensorqc.functions import texts
from sensorqc.operators import extensions as X
from sensorqc.plans.registry import AS_OF, DAY, FIXTURE_RULES, SENSOR
from sensorqc.rules import DEFAULT_RULES, QualityRules
from sensorqc.sources import fixtures as fx

AS_OF_SQL = f"TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}'"


def _d(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def _s(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _area_sql() -> str:
    whens = " ".join(f"WHEN {i} THEN {_s(a)}" for i, a in enumerate(fx.AREAS))
    return f"CASE user_id % {len(fx.AREAS)} {whens} END"


def readings_cte(name: str = "readings", late: bool = False, coarse: bool = False) -> str:
    us = f"{fx.BASE_US} + (epoch_us(ts) - {fx.BASE_US}) // {fx.SQUEEZE}"
    if late:
        us = (f"CASE WHEN event_id % {fx.LATE_EVERY} = 0 THEN {us} - ({fx.LATE_BASE_S} + event_id % "
              f"{fx.LATE_SPREAD}) * 1000000 ELSE {us} END")
    if coarse:
        us = f"({us}) // 60000000 * 60000000"
    return f"""{name} AS (
  SELECT seq, sensor_id, area, us, make_timestamp(us) AS timestamp, temperature, humidity, wind_speed FROM (
    SELECT event_id AS seq,
           'SNS-' || lpad(CAST(user_id AS VARCHAR), 5, '0') AS sensor_id,
           {_area_sql()} AS area,
           {us} AS us,
           CASE WHEN event_type = 'error' OR event_id % 20 = 0 THEN NULL
                ELSE value * {_d(0.4)} - {_d(10)} END AS temperature,
           CASE WHEN event_type = 'error' OR event_id % 17 = 0 THEN NULL
                ELSE CAST(regexp_extract(props, '(\\d+)', 1) AS DOUBLE) * {_d(1.05)} END AS humidity,
           CASE WHEN event_type = 'error' OR event_id % 13 = 0 THEN NULL
                ELSE value / {_d(5)} END AS wind_speed
    FROM events))"""


FIELDS = ("temperature", "humidity", "wind_speed")


def _range(rules: QualityRules, f: str) -> str:
    lo, hi = rules.range_of(f)
    return f"{f} BETWEEN {_d(lo)} AND {_d(hi)}"


def w1_cte(src: str = "readings", name: str = "stats", rules: QualityRules = FIXTURE_RULES) -> str:
    """W1 in SQL: one RANGE frame per reading over µs event time."""
    sums = []
    for f in FIELDS:
        sums.append(f"CAST(sum(CASE WHEN {f} IS NULL THEN 1 ELSE 0 END) OVER w AS BIGINT) AS {f}_nulls")
    for f in FIELDS:
        sums.append(f"CAST(sum(CASE WHEN {f} IS NOT NULL THEN 1 ELSE 0 END) OVER w AS BIGINT) AS {f}_n")
        sums.append(f"CAST(sum(CASE WHEN {_range(rules, f)} THEN 1 ELSE 0 END) OVER w AS BIGINT) AS {f}_valid")
    return f"""{name}_lag AS (
  SELECT *, lag(temperature) OVER (PARTITION BY sensor_id ORDER BY us) AS prev_t FROM {src}),
{name}_flag AS (
  SELECT *, CASE WHEN temperature IS NOT NULL AND prev_t IS NOT NULL THEN 1 ELSE 0 END AS pf,
         CASE WHEN temperature IS NOT NULL AND prev_t IS NOT NULL AND abs(temperature - prev_t) > {_d(rules.jump_limit)}
              AND NOT isnan(temperature - prev_t) THEN 1 ELSE 0 END AS jf
  FROM {name}_lag),
{name} AS (
  SELECT seq, sensor_id, area, us, timestamp, count(*) OVER w AS n,
         {", ".join(sums)},
         CAST(sum(pf) OVER w - first_value(pf) OVER w AS BIGINT) AS pairs,
         CAST(sum(jf) OVER w - first_value(jf) OVER w AS BIGINT) AS jumps,
         make_timestamp(min(us) OVER w) AS window_start, timestamp AS window_end
  FROM {name}_flag
  WINDOW w AS (PARTITION BY sensor_id ORDER BY us RANGE BETWEEN {rules.window_us - 1} PRECEDING AND CURRENT ROW))"""


def w1_ties_cte(src: str = "readings", name: str = "stats", rules: QualityRules = FIXTURE_RULES) -> str:
    """W1 where times repeat: j is in the window of i iff it is not after i by (us, seq) and us_j > us_i - W."""
    cnt = []
    for f in FIELDS:
        cnt.append(f"CAST(count(*) FILTER (WHERE j.{f} IS NULL) AS BIGINT) AS {f}_nulls")
    for f in FIELDS:
        cnt.append(f"CAST(count(j.{f}) AS BIGINT) AS {f}_n")
        cnt.append(f"CAST(count(*) FILTER (WHERE j.{_range(rules, f)}) AS BIGINT) AS {f}_valid")
    return f"""{name}_pairs AS (
  SELECT i.seq AS iseq, j.*, lag(j.temperature) OVER (PARTITION BY i.seq ORDER BY j.us, j.seq) AS prev_t
  FROM {src} i JOIN {src} j ON j.sensor_id = i.sensor_id AND j.us > i.us - {rules.window_us}
       AND (j.us < i.us OR (j.us = i.us AND j.seq <= i.seq))),
{name}_agg AS (
  SELECT iseq, count(*) AS n, {", ".join(cnt)},
         CAST(count(*) FILTER (WHERE j.temperature IS NOT NULL AND j.prev_t IS NOT NULL) AS BIGINT) AS pairs,
         CAST(count(*) FILTER (WHERE j.temperature IS NOT NULL AND j.prev_t IS NOT NULL
               AND abs(j.temperature - j.prev_t) > {_d(rules.jump_limit)}) AS BIGINT) AS jumps,
         make_timestamp(min(j.us)) AS window_start
  FROM {name}_pairs j GROUP BY iseq),
{name} AS (
  SELECT r.seq, r.sensor_id, r.area, r.us, r.timestamp, a.n,
         {", ".join(f"a.{f}_nulls" for f in FIELDS)},
         {", ".join(f"a.{f}_n, a.{f}_valid" for f in FIELDS)},
         a.pairs, a.jumps, a.window_start, r.timestamp AS window_end
  FROM {src} r JOIN {name}_agg a ON a.iseq = r.seq)"""


def w2_cte(src: str = "readings", name: str = "stats", rules: QualityRules = FIXTURE_RULES) -> str:
    """W2 in SQL: j is in the window of i iff seq_j <= seq_i < dead(j), where
    dead(j) is the first later reading of the sensor at least one window newer."""
    cnt = []
    for f in FIELDS:
        cnt.append(f"CAST(count(*) FILTER (WHERE j.{f} IS NULL) AS BIGINT) AS {f}_nulls")
    for f in FIELDS:
        cnt.append(f"CAST(count(j.{f}) AS BIGINT) AS {f}_n")
        cnt.append(f"CAST(count(*) FILTER (WHERE j.{_range(rules, f)}) AS BIGINT) AS {f}_valid")
    return f"""{name}_dead AS (
  SELECT a.*, (SELECT min(b.seq) FROM {src} b WHERE b.sensor_id = a.sensor_id AND b.seq > a.seq
               AND b.us >= a.us + {rules.window_us}) AS dead FROM {src} a),
{name}_pairs AS (
  SELECT i.seq AS iseq, j.*, lag(j.temperature) OVER (PARTITION BY i.seq ORDER BY j.seq) AS prev_t
  FROM {src} i JOIN {name}_dead j ON j.sensor_id = i.sensor_id AND j.seq <= i.seq
       AND (j.dead IS NULL OR i.seq < j.dead)),
{name}_agg AS (
  SELECT iseq, count(*) AS n, {", ".join(cnt)},
         CAST(count(*) FILTER (WHERE j.temperature IS NOT NULL AND j.prev_t IS NOT NULL) AS BIGINT) AS pairs,
         CAST(count(*) FILTER (WHERE j.temperature IS NOT NULL AND j.prev_t IS NOT NULL
               AND abs(j.temperature - j.prev_t) > {_d(rules.jump_limit)}
               AND NOT isnan(j.temperature - j.prev_t)) AS BIGINT) AS jumps,
         make_timestamp(arg_min(j.us, j.seq)) AS window_start
  FROM {name}_pairs j GROUP BY iseq),
{name} AS (
  SELECT r.seq, r.sensor_id, r.area, r.us, r.timestamp, a.n,
         {", ".join(f"a.{f}_nulls" for f in FIELDS)},
         {", ".join(f"a.{f}_n, a.{f}_valid" for f in FIELDS)},
         a.pairs, a.jumps, a.window_start, r.timestamp AS window_end
  FROM {src} r JOIN {name}_agg a ON a.iseq = r.seq)"""


STATS_COLS = ("seq, sensor_id, area, us, timestamp, n, temperature_nulls, humidity_nulls, wind_speed_nulls, "
              "temperature_n, temperature_valid, humidity_n, humidity_valid, wind_speed_n, wind_speed_valid, "
              "pairs, jumps, window_start, window_end")


def _metric_selects(rules: QualityRules, stats: str) -> dict[str, str]:
    head = "seq, sensor_id, area, timestamp"
    tail = "window_start, window_end"
    miss = f"(CAST(temperature_nulls + humidity_nulls + wind_speed_nulls AS DOUBLE) / (n * 3)) * 100"
    out = {
        "completeness": (
            f"SELECT {head}, 'completeness' AS metric_name, 0 AS metric_order, {_d(100)} - {miss} AS metric_value, "
            f"{_d(100 - rules.max_missing_percent)} AS threshold, "
            f"CASE WHEN {miss} <= {_d(rules.max_missing_percent)} THEN 'PASS' ELSE 'FAIL' END AS status, {tail} FROM {stats}"),
    }
    for i, f in enumerate(FIELDS, start=1):
        rate = f"(CAST({f}_valid AS DOUBLE) / {f}_n) * 100"
        out[f"{f}_validity"] = (
            f"SELECT {head}, '{f}_validity' AS metric_name, {i} AS metric_order, {rate} AS metric_value, "
            f"{_d(rules.validity_threshold)} AS threshold, "
            f"CASE WHEN {rate} >= {_d(rules.validity_threshold)} THEN 'PASS' ELSE 'FAIL' END AS status, {tail} "
            f"FROM {stats} WHERE {f}_n > 0")
    rate = f"least((n / {_d(rules.expected_points)}) * 100, {_d(100)})"
    out["timeliness"] = (
        f"SELECT {head}, 'timeliness' AS metric_name, 4 AS metric_order, {rate} AS metric_value, "
        f"{_d(rules.timeliness_threshold)} AS threshold, "
        f"CASE WHEN {rate} >= {_d(rules.timeliness_threshold)} THEN 'PASS' ELSE 'FAIL' END AS status, {tail} "
        f"FROM {stats}")
    rate = f"CASE WHEN pairs > 0 THEN (CAST(pairs - jumps AS DOUBLE) / pairs) * 100 ELSE {_d(100)} END"
    out["consistency"] = (
        f"SELECT {head}, 'consistency' AS metric_name, 5 AS metric_order, "
        f"CASE WHEN n < 2 THEN {_d(100)} ELSE {rate} END AS metric_value, "
        f"{_d(rules.consistency_threshold)} AS threshold, "
        f"CASE WHEN n < 2 OR {rate} >= {_d(rules.consistency_threshold)} THEN 'PASS' ELSE 'FAIL' END AS status, "
        f"CASE WHEN n < 2 THEN timestamp - INTERVAL 5 MINUTE ELSE window_start END AS window_start, "
        f"CASE WHEN n < 2 THEN timestamp ELSE window_end END AS window_end FROM {stats}")
    return out


def metrics_cte(name: str = "metrics", stats: str = "stats", rules: QualityRules = FIXTURE_RULES,
                names: tuple[str, ...] | None = None) -> str:
    sel = _metric_selects(rules, stats)
    parts = [sel[n] for n in sel if names is None or n in names]
    return f"{name} AS (\n  " + "\n  UNION ALL ".join(parts) + ")"


def _fmt1(col: str) -> str:
    return f"printf('%.1f', {col})"


def _message_sql() -> str:
    def render(template: str) -> str:
        out = _s(template)
        out = out.replace("{v}", "' || " + _fmt1("metric_value") + " || '")
        out = out.replace("{t}", "' || " + _fmt1("threshold") + " || '")
        return out.replace("{name}", "' || metric_name || '")
    whens = " ".join(f"WHEN {_s(m)} THEN {render(t)}" for m, t in texts.ALERT_MESSAGES.items())
    return f"CASE metric_name {whens} ELSE {render(texts.ALERT_MESSAGE_DEFAULT)} END"


SEVERITY_SQL = ("CASE WHEN metric_name = 'completeness' AND metric_value < 50 THEN 'CRITICAL' "
                "WHEN metric_name = 'timeliness' AND metric_value < 70 THEN 'HIGH' "
                "WHEN metric_name LIKE '%validity%' AND metric_value < 80 THEN 'HIGH' "
                "WHEN metric_name = 'consistency' AND metric_value < 60 THEN 'MEDIUM' ELSE 'LOW' END")


def _rank_sql(col: str) -> str:
    whens = " ".join(f"WHEN {_s(s)} THEN {i}" for i, s in enumerate(texts.SEVERITIES, start=1))
    return f"CASE {col} {whens} END"


def _lookup_sql(col: str, table: dict[str, str], default: str) -> str:
    whens = " ".join(f"WHEN {_s(k)} THEN {_s(v)}" for k, v in table.items())
    return f"CASE {col} {whens} ELSE {_s(default)} END"


def alerts_cte(name: str = "alerts", metrics: str = "metrics") -> str:
    return f"""{name} AS (
  SELECT seq, sensor_id, timestamp, 'QUALITY_ALERT' AS alert_type, severity, {_rank_sql('severity')} AS severity_rank,
         message, metric_name, metric_order, metric_value, threshold, false AS resolved
  FROM (SELECT *, {SEVERITY_SQL} AS severity, {_message_sql()} AS message FROM {metrics} WHERE status = 'FAIL'))"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _pipeline(upto: str = "alerts", rules: QualityRules = FIXTURE_RULES, late: bool = False,
              window: str = "w1") -> list[str]:
    ctes = [readings_cte(late=late)]
    if upto == "readings":
        return ctes
    ctes.append((w1_cte if window == "w1" else w2_cte)(rules=rules))
    if upto == "stats":
        return ctes
    ctes.append(metrics_cte(rules=rules))
    if upto == "metrics":
        return ctes
    ctes.append(alerts_cte())
    return ctes


def _lower(hours: float = 0, minutes: float = 0) -> str:
    return f"{AS_OF_SQL} - INTERVAL {int(hours * 60 + minutes)} MINUTE"


def _summary_cte(hours: float = 24) -> str:
    return f"""summary AS (
  SELECT sensor_id, metric_name, round(avg(metric_value), 6) AS avg_value, min(metric_value) AS min_value,
         max(metric_value) AS max_value,
         CAST(count(*) FILTER (WHERE status = 'FAIL') AS BIGINT) AS fail_count,
         CAST(count(*) FILTER (WHERE status = 'PASS') AS BIGINT) AS pass_count
  FROM metrics WHERE timestamp >= {_lower(hours)} GROUP BY sensor_id, metric_name)"""


RATES_CTE = """rates AS (
  SELECT sensor_id, total_checks, failed_checks, (CAST(failed_checks AS DOUBLE) / total_checks) * 100 AS failure_rate
  FROM (SELECT sensor_id, CAST(sum(pass_count) + sum(fail_count) AS BIGINT) AS total_checks,
               CAST(sum(fail_count) AS BIGINT) AS failed_checks FROM summary GROUP BY sensor_id)
  WHERE total_checks > 0)"""


def _json_cte() -> str:
    iso = ("CASE WHEN epoch_us(timestamp) % 1000000 = 0 THEN strftime(timestamp, '%Y-%m-%dT%H:%M:%S') "
           "ELSE strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f') END")
    ts = f"CASE WHEN seq % {fx.BAD_TS_EVERY} = 0 THEN 'x' ELSE {iso} END"
    sid = f"CASE WHEN seq % {fx.BLANK_ID_EVERY} = 0 THEN '' ELSE sensor_id END"
    text = (f"CAST(json_object('timestamp', {ts}, 'sensor_id', {sid}, 'area', area, 'temperature', temperature, "
            f"'humidity', humidity, 'wind_speed', wind_speed) AS VARCHAR)")
    return f"""msgs AS (
  SELECT seq, CASE WHEN seq % {fx.CUT_JSON_EVERY} = 0 THEN substr({text}, 1, 40) ELSE {text} END AS value
  FROM readings),
parsed AS (
  SELECT seq,
    CASE WHEN NOT json_valid(value) THEN 'malformed_json'
         WHEN json_extract_string(value, '$.sensor_id') IS NULL OR json_extract_string(value, '$.sensor_id') = ''
           THEN 'missing_sensor_id'
         WHEN TRY_CAST(json_extract_string(value, '$.timestamp') AS TIMESTAMP) IS NULL THEN 'bad_timestamp'
    END AS reject_reason,
    CASE WHEN json_valid(value) THEN json_extract_string(value, '$.sensor_id') END AS sensor_id,
    CASE WHEN json_valid(value) THEN json_extract_string(value, '$.area') END AS area,
    CASE WHEN json_valid(value) THEN TRY_CAST(json_extract_string(value, '$.timestamp') AS TIMESTAMP) END AS timestamp,
    CASE WHEN json_valid(value) THEN TRY_CAST(json_extract_string(value, '$.temperature') AS DOUBLE) END AS temperature,
    CASE WHEN json_valid(value) THEN TRY_CAST(json_extract_string(value, '$.humidity') AS DOUBLE) END AS humidity,
    CASE WHEN json_valid(value) THEN TRY_CAST(json_extract_string(value, '$.wind_speed') AS DOUBLE) END AS wind_speed
  FROM msgs),
parsed2 AS (SELECT seq, sensor_id, area, epoch_us(timestamp) AS us, timestamp, temperature, humidity, wind_speed,
                   reject_reason FROM parsed)"""


def _system_events_cte() -> str:
    return """sysev AS (
  SELECT event_id AS seq, ts AS timestamp,
    CASE event_type WHEN 'error' THEN 'SYSTEM_ERROR' WHEN 'signup' THEN 'SENSOR_OFFLINE' WHEN 'click' THEN 'DATA_DELAY'
         WHEN 'purchase' THEN 'THRESHOLD_BREACH' ELSE 'SYSTEM_START' END AS alert_type,
    'event ' || CAST(event_id AS VARCHAR) || ': ' || event_type AS message,
    CASE WHEN value >= 75 THEN 'CRITICAL' WHEN value >= 50 THEN 'HIGH' WHEN value >= 25 THEN 'MEDIUM'
         WHEN value >= 10 THEN 'LOW' ELSE 'UNKNOWN' END AS severity
  FROM events)"""


def _notif_cte() -> str:
    return f"""cand AS (SELECT * FROM alerts WHERE severity IN ('HIGH', 'CRITICAL')),
notif AS (
  SELECT sensor_id, seq, CAST(count(*) AS BIGINT) AS fail_count, max(timestamp) AS timestamp,
         string_agg(initcap_name || chr(10) || '현재값: ' || printf('%.2f', metric_value) || chr(10) || '임계값: '
                    || printf('%.2f', threshold) || chr(10) || '상태: FAIL', chr(10) || chr(10) ORDER BY metric_order)
           AS fields_text
  FROM (SELECT *, array_to_string(list_transform(string_split(metric_name, '_'),
               lambda x: upper(substr(x, 1, 1)) || lower(substr(x, 2))), ' ') AS initcap_name FROM cand)
  GROUP BY sensor_id, seq)"""


def _count_sev(col: str) -> str:
    return (f"CASE WHEN {col} >= 3 THEN 'CRITICAL' WHEN {col} >= 2 THEN 'HIGH' WHEN {col} >= 1 THEN 'MEDIUM' "
            f"ELSE 'LOW' END")


def _color(col: str) -> str:
    return _lookup_sql(col, texts.SEVERITY_COLORS, texts.SEVERITY_COLOR_DEFAULT)


def _emoji(col: str) -> str:
    return _lookup_sql(col, texts.ALERT_EMOJIS, texts.ALERT_EMOJI_DEFAULT)


def _sliding_sql() -> str:
    return _with(readings_cte(), """exp AS (
  SELECT r.*, time_bucket(INTERVAL 1 MINUTE, timestamp) - k * INTERVAL 1 MINUTE AS window_start
  FROM readings r, range(0, 5) t(k))""") + """
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, sensor_id, count(*) AS record_count,
       round(avg(CAST(temperature AS FLOAT)), 6) AS avg_temperature,
       round(avg(CAST(humidity AS FLOAT)), 6) AS avg_humidity,
       round(avg(CAST(wind_speed AS FLOAT)), 6) AS avg_wind_speed,
       round(stddev_samp(CAST(temperature AS FLOAT)), 6) AS temp_stddev
FROM exp GROUP BY window_start, sensor_id"""


def oracle_sql() -> dict[str, str]:
    R, M, AL = _pipeline("readings"), _pipeline("metrics"), _pipeline("alerts")
    q: dict[str, str] = {}
    q["read_table"] = "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 72 HOUR"
    q["apply_retention"] = "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-25 00:00:00' - INTERVAL 10 DAY"
    q["parse_readings"] = _with(*R, _json_cte()) + "SELECT p.*, m.value AS raw FROM parsed2 p JOIN msgs m USING (seq)"
    q["accept_readings"] = _with(*R, _json_cte()) + (
        "SELECT seq, sensor_id, area, us, timestamp, temperature, humidity, wind_speed FROM parsed2 "
        "WHERE reject_reason IS NULL")
    q["reject_readings"] = _with(*R, _json_cte()) + (
        "SELECT seq, reject_reason, m.value AS raw FROM parsed2 JOIN msgs m USING (seq) WHERE reject_reason IS NOT NULL")
    q["within_lookback"] = _with(*R) + f"SELECT * FROM readings WHERE timestamp >= {_lower(minutes=10)}"
    q["sensor_readings"] = _with(*R) + f"SELECT * FROM readings WHERE sensor_id = {_s(SENSOR)}"
    q["failed_metrics"] = _with(*M) + "SELECT * FROM metrics WHERE status = 'FAIL'"
    iso = lambda c: (f"CASE WHEN epoch_us({c}) % 1000000 = 0 THEN strftime({c}, '%Y-%m-%dT%H:%M:%S') "  # noqa: E731
                     f"ELSE strftime({c}, '%Y-%m-%dT%H:%M:%S.%f') END")
    q["publish_metrics"] = _with(*M) + (
        f"SELECT {iso('timestamp')} AS timestamp, sensor_id, metric_name, metric_value AS value, threshold, status, "
        f"{iso('window_start')} AS window_start, {iso('window_end')} AS window_end FROM metrics")
    q["publish_metrics_json"] = _with(*M) + (
        f"SELECT sensor_id, metric_name, {iso('timestamp')} AS timestamp, CAST(json_object('timestamp', {iso('timestamp')}, "
        f"'sensor_id', sensor_id, 'metric_name', metric_name, 'value', metric_value, 'threshold', threshold, "
        f"'status', status, 'window_start', {iso('window_start')}, 'window_end', {iso('window_end')}) AS VARCHAR) "
        f"AS value_json FROM metrics")
    q["trailing_window"] = _with(*_pipeline("stats")) + f"SELECT {STATS_COLS} FROM stats"
    q["trailing_window_buckets"] = q["trailing_window"]
    q["trailing_window_ties"] = _with(readings_cte(coarse=True), w1_ties_cte()) + f"SELECT {STATS_COLS} FROM stats"
    q["arrival_window"] = _with(*_pipeline("stats", late=True, window="w2")) + f"SELECT {STATS_COLS} FROM stats"
    q["arrival_window_chunks"] = q["arrival_window"]
    for name in ("completeness", "temperature_validity", "humidity_validity", "wind_speed_validity",
                 "timeliness", "consistency"):
        q[name] = _with(*_pipeline("stats"), metrics_cte(names=(name,))) + "SELECT * FROM metrics"
    q["timeliness_5s"] = _with(*_pipeline("stats", rules=DEFAULT_RULES),
                               metrics_cte(rules=DEFAULT_RULES, names=("timeliness",))) + "SELECT * FROM metrics"
    q["quality_metrics"] = _with(*M) + "SELECT * FROM metrics"
    q["arrival_quality_metrics"] = _with(*_pipeline("metrics", late=True, window="w2")) + "SELECT * FROM metrics"
    q["alert_severity"] = _with(*M) + (
        f"SELECT seq, sensor_id, metric_name, metric_value, {SEVERITY_SQL} AS severity, "
        f"{_rank_sql(SEVERITY_SQL)} AS severity_rank FROM metrics WHERE status = 'FAIL'")
    q["alert_messages"] = _with(*M) + (
        f"SELECT seq, sensor_id, metric_name, {_message_sql()} AS message FROM metrics WHERE status = 'FAIL'")
    q["alerts"] = _with(*AL) + "SELECT * FROM alerts"
    q["notify_candidates"] = _with(*AL) + "SELECT * FROM alerts WHERE severity IN ('HIGH', 'CRITICAL')"
    nsev = ("SELECT sensor_id, seq, CAST(count(*) AS BIGINT) AS fail_count FROM alerts "
            "WHERE severity IN ('HIGH', 'CRITICAL') GROUP BY sensor_id, seq")
    q["notification_severity"] = _with(*AL) + f"SELECT *, {_count_sev('fail_count')} AS severity FROM ({nsev})"
    q["notification_severity_from_alerts"] = q["notification_severity"]
    q["severity_colors"] = _with(*AL) + (
        f"SELECT *, {_color('severity')} AS color FROM "
        f"(SELECT *, {_count_sev('fail_count')} AS severity FROM ({nsev}))")
    q["alert_emojis"] = _with(_system_events_cte()) + f"SELECT seq, alert_type, {_emoji('alert_type')} AS emoji FROM sysev"
    q["quality_notifications"] = _with(*AL, _notif_cte()) + (
        f"SELECT sensor_id, seq, timestamp, fail_count, {_count_sev('fail_count')} AS severity, "
        f"{_color(_count_sev('fail_count'))} AS color, '🚨 데이터 품질 알림 - ' || sensor_id AS title, "
        f"'센서 ' || sensor_id || '에서 데이터 품질 문제가 감지되었습니다.' AS text, fields_text FROM notif")
    q["quality_notifications_from_alerts"] = q["quality_notifications"]
    q["quality_notification_payloads"] = _with(*AL, _notif_cte()) + f"""
SELECT sensor_id, seq, CAST(json_object(
    'channel', {_s(texts.DEFAULT_CHANNEL)}, 'username', {_s(texts.QUALITY_USERNAME)}, 'icon_emoji', {_s(texts.QUALITY_ICON)},
    'text', '센서 ' || sensor_id || '에서 데이터 품질 문제가 감지되었습니다.', 'attachments', [json_object(
      'color', {_color(_count_sev('fail_count'))}, 'title', '🚨 데이터 품질 알림 - ' || sensor_id, 'fields', fields,
      'footer', {_s(texts.FOOTER)}, 'ts', epoch_us(timestamp) // 1000000)]) AS VARCHAR) AS payload
FROM (SELECT sensor_id, seq, count(*) AS fail_count, max(timestamp) AS timestamp, list(json_object(
        'title', array_to_string(list_transform(string_split(metric_name, '_'),
                 lambda x: upper(substr(x, 1, 1)) || lower(substr(x, 2))), ' '),
        'value', '현재값: ' || printf('%.2f', metric_value) || chr(10) || '임계값: ' || printf('%.2f', threshold)
                 || chr(10) || '상태: FAIL', 'short', true) ORDER BY metric_order) AS fields
      FROM cand GROUP BY sensor_id, seq)"""
    q["system_notification_payloads"] = _with(_system_events_cte()) + f"""
SELECT seq, CAST(json_object(
    'channel', {_s(texts.DEFAULT_CHANNEL)}, 'username', {_s(texts.SYSTEM_USERNAME)}, 'icon_emoji', {_s(texts.SYSTEM_ICON)},
    'attachments', [json_object('color', {_color('severity')},
      'title', {_emoji('alert_type')} || ' 시스템 알림 - ' || alert_type, 'text', message,
      'footer', {_s(texts.FOOTER)}, 'ts', epoch_us(timestamp) // 1000000)]) AS VARCHAR) AS payload
FROM sysev"""
    q["system_notifications"] = _with(_system_events_cte()) + (
        f"SELECT seq, timestamp, alert_type, message, severity, {_color('severity')} AS color, "
        f"{_emoji('alert_type')} AS emoji, {_emoji('alert_type')} || ' 시스템 알림 - ' || alert_type AS title FROM sysev")
    day0, day1 = f"TIMESTAMP '{DAY} 00:00:00'", f"TIMESTAMP '{DAY} 00:00:00' + INTERVAL 1 DAY"
    inday = f"timestamp >= {day0} AND timestamp < {day1}"
    q["daily_summary"] = _with(*M) + f"""
SELECT DATE '{DAY}' AS day, r.total_sensors, r.total_records, m.quality_checks, m.failed_checks,
       format('{{:,}}', r.total_records) AS total_records_text, format('{{:,}}', m.quality_checks) AS quality_checks_text,
       format('{{:,}}', m.failed_checks) AS failed_checks_text, t.top_sensors_text
FROM (SELECT CAST(count(DISTINCT sensor_id) AS BIGINT) AS total_sensors, CAST(count(*) AS BIGINT) AS total_records
      FROM readings WHERE {inday}) r,
     (SELECT CAST(count(*) AS BIGINT) AS quality_checks,
             CAST(count(*) FILTER (WHERE status = 'FAIL') AS BIGINT) AS failed_checks FROM metrics WHERE {inday}) m,
     (SELECT coalesce(string_agg('• ' || sensor_id || ': ' || CAST(fail_count AS VARCHAR) || '건', chr(10)
                       ORDER BY fail_count DESC, sensor_id), '') AS top_sensors_text
      FROM (SELECT sensor_id, count(*) AS fail_count FROM metrics WHERE {inday} AND status = 'FAIL'
            GROUP BY sensor_id ORDER BY fail_count DESC, sensor_id LIMIT 5)) t"""
    titles = texts.SUMMARY_FIELD_TITLES
    q["daily_summary_payload"] = f"""
SELECT day, CAST(json_object(
    'channel', {_s(texts.DEFAULT_CHANNEL)}, 'username', {_s(texts.SUMMARY_USERNAME)}, 'icon_emoji', {_s(texts.SUMMARY_ICON)},
    'attachments', [json_object('color', 'good', 'title', {_s(texts.SUMMARY_TITLE)}, 'fields', [
        json_object('title', {_s(titles[0])}, 'value', CAST(total_sensors AS VARCHAR), 'short', true),
        json_object('title', {_s(titles[1])}, 'value', total_records_text, 'short', true),
        json_object('title', {_s(titles[2])}, 'value', quality_checks_text, 'short', true),
        json_object('title', {_s(titles[3])}, 'value', failed_checks_text, 'short', true),
        json_object('title', {_s(texts.SUMMARY_TOP_TITLE)}, 'value', top_sensors_text, 'short', false)],
      'footer', {_s(texts.FOOTER)}, 'ts', epoch_us({day1}) // 1000000)]) AS VARCHAR) AS payload
FROM ({q["daily_summary"]})"""
    q["sensor_data_count"] = _with(*R) + f"SELECT CAST(count(*) AS BIGINT) AS count FROM readings WHERE timestamp >= {_lower(24)}"
    q["sensor_data_count_sensor"] = _with(*R) + (
        f"SELECT CAST(count(*) AS BIGINT) AS count FROM readings WHERE timestamp >= {_lower(24)} "
        f"AND sensor_id = {_s(SENSOR)}")
    q["sensor_data_count_10m"] = _with(*R) + (
        f"SELECT CAST(count(*) AS BIGINT) AS count FROM readings WHERE timestamp >= {_lower(minutes=10)}")
    q["quality_metrics_summary"] = _with(*M, _summary_cte()) + "SELECT * FROM summary"
    q["active_alerts"] = _with(*AL) + (
        f"SELECT timestamp, sensor_id, alert_type, severity, message, metric_name, metric_value, threshold "
        f"FROM alerts WHERE timestamp >= {_lower(24)} AND NOT resolved")
    q["average_temperature_series"] = _with(*R) + (
        f"SELECT timestamp, round(avg(temperature), 6) AS avg_temp FROM readings WHERE timestamp >= {_lower(1)} "
        f"GROUP BY timestamp")
    score = (f"SELECT round(avg(metric_value), 6) AS quality_score FROM metrics WHERE timestamp >= {_lower(1)} "
             f"AND metric_name = 'completeness'")
    q["completeness_score"] = _with(*M) + score
    q["completeness_band"] = _with(*M) + (
        f"SELECT quality_score, CASE WHEN quality_score < 80 THEN 'red' WHEN quality_score < 95 THEN 'yellow' "
        f"ELSE 'green' END AS band FROM ({score})")
    q["status_distribution"] = _with(*M) + (
        f"SELECT status, CAST(count(*) AS BIGINT) AS count FROM metrics WHERE timestamp >= {_lower(1)} GROUP BY status")
    q["recent_alerts"] = _with(*AL) + (
        f"SELECT sensor_id, alert_type, severity, message, timestamp FROM alerts WHERE timestamp >= {_lower(1)} "
        f"AND NOT resolved ORDER BY timestamp DESC, sensor_id, metric_order LIMIT 10")
    q["severity_counts"] = _with(*AL) + (
        "SELECT severity, severity_rank, CAST(count(*) AS BIGINT) AS count FROM alerts GROUP BY severity, severity_rank")
    q["recent_critical_alerts"] = _with(*AL) + (
        "SELECT timestamp, sensor_id, message FROM alerts WHERE severity = 'CRITICAL' "
        "ORDER BY timestamp DESC, sensor_id, metric_order LIMIT 5")
    q["sensor_failure_rates"] = _with(*M, _summary_cte(), RATES_CTE) + "SELECT * FROM rates"
    q["top_problem_sensors"] = _with(*M, _summary_cte(), RATES_CTE) + (
        "SELECT * FROM rates ORDER BY failure_rate DESC, sensor_id LIMIT 5")
    q["active_sensor_count"] = _with(*M, _summary_cte()) + (
        "SELECT CAST(count(DISTINCT sensor_id) AS BIGINT) AS active_sensors_count FROM summary")
    q["system_statistics"] = _with(*AL, _summary_cte(), RATES_CTE) + f"""
SELECT c.total_data_points, c.recent_data_points, g.quality_metrics_count, a.active_alerts_count,
       g.active_sensors_count, t.top_sensor_ids
FROM (SELECT CAST(count(*) AS BIGINT) AS total_data_points,
             CAST(count(*) FILTER (WHERE timestamp >= {_lower(1)}) AS BIGINT) AS recent_data_points
      FROM readings WHERE timestamp >= {_lower(24 * 30)}) c,
     (SELECT CAST(count(*) AS BIGINT) AS quality_metrics_count,
             CAST(count(DISTINCT sensor_id) AS BIGINT) AS active_sensors_count FROM summary) g,
     (SELECT CAST(count(*) AS BIGINT) AS active_alerts_count FROM alerts
      WHERE timestamp >= {_lower(24)} AND NOT resolved) a,
     (SELECT coalesce(string_agg(sensor_id, ',' ORDER BY failure_rate DESC, sensor_id), '') AS top_sensor_ids
      FROM (SELECT * FROM rates ORDER BY failure_rate DESC, sensor_id LIMIT 5)) t"""
    q["quality_metrics_summary_rollups"] = _with(*M, _summary_cte(0.25)) + "SELECT * FROM summary"
    q["system_statistics_rollups"] = q["system_statistics"]
    q["summary_head"] = _with(*M, _summary_cte()) + "SELECT * FROM summary ORDER BY sensor_id, metric_name LIMIT 10"
    q["monitor_health_stopped"] = _with(*R) + f"""
SELECT (SELECT CAST(count(*) AS BIGINT) FROM readings WHERE timestamp >= {_lower(1)}) AS recent_data_count,
       CAST(count(DISTINCT sensor_id) AS BIGINT) AS active_sensors, CAST(count(*) AS BIGINT) AS processed_count,
       'stopped' AS status, '{AS_OF.isoformat()}' AS timestamp, false AS processor_running, CAST(NULL AS VARCHAR) AS error
FROM readings"""
    q["system_statistics_top"] = _with(*M, _summary_cte(), RATES_CTE) + (
        "SELECT sensor_id, failure_rate, total_checks, failed_checks FROM rates "
        "ORDER BY failure_rate DESC, sensor_id LIMIT 5")
    q["monitor_health"] = _with(*R) + f"""
SELECT (SELECT CAST(count(*) AS BIGINT) FROM readings WHERE timestamp >= {_lower(1)}) AS recent_data_count,
       CAST(count(DISTINCT sensor_id) AS BIGINT) AS active_sensors, CAST(count(*) AS BIGINT) AS processed_count,
       'healthy' AS status
FROM readings"""
    on_time = f"{fx.BASE_US} + (epoch_us(ts) - {fx.BASE_US}) // {fx.SQUEEZE}"
    q["delayed_readings"] = _with(readings_cte(late=True), f"""recv AS (
  SELECT r.*, make_timestamp({on_time}) AS received_at FROM readings r JOIN events e ON e.event_id = r.seq)""") + (
        "SELECT *, CAST(epoch_us(received_at) - epoch_us(timestamp) AS DOUBLE) / 1000000 AS delay_seconds FROM recv "
        f"WHERE epoch_us(received_at) - epoch_us(timestamp) > {X.DELAY_LIMIT_SECONDS * 1_000_000}")
    q["offline_sensors"] = _with(*R) + (
        f"SELECT k.sensor_id, l.last_seen FROM (SELECT DISTINCT 'SNS-' || lpad(CAST(c_custkey AS VARCHAR), 5, '0') "
        f"AS sensor_id FROM customer) k LEFT JOIN (SELECT sensor_id, max(timestamp) AS last_seen FROM readings "
        f"GROUP BY sensor_id) l ON k.sensor_id = l.sensor_id "
        f"WHERE l.last_seen IS NULL OR l.last_seen <= {AS_OF_SQL} - INTERVAL {FIXTURE_RULES.time_window_minutes} MINUTE")
    season = " ".join(f"WHEN month(timestamp) IN ({', '.join(map(str, months))}) THEN {{}}"
                      for _, months, _ in X.SEASONAL_TEMPERATURE)
    pick = lambda k: "CASE " + season.format(*[
        (_s(n) if k == 0 else _d(rng[k - 1])) for n, _, rng in X.SEASONAL_TEMPERATURE]) + " END"
    q["seasonal_validity"] = _with(*R) + (
        f"SELECT *, CASE WHEN temperature IS NULL THEN NULL "
        f"ELSE temperature BETWEEN temperature_lo AND temperature_hi END AS temperature_in_range FROM "
        f"(SELECT *, {pick(0)} AS season, {pick(1)} AS temperature_lo, {pick(2)} AS temperature_hi FROM readings)")
    q["area_quality"] = _with(*M) + (
        "SELECT area, metric_name, round(avg(metric_value), 6) AS avg_value, CAST(count(*) AS BIGINT) AS checks, "
        "CAST(count(*) FILTER (WHERE status = 'FAIL') AS BIGINT) AS failed_checks, "
        "(CAST(count(*) FILTER (WHERE status = 'FAIL') AS DOUBLE) / count(*)) * 100 AS failure_rate "
        "FROM metrics GROUP BY area, metric_name")
    q["sliding_aggregate"] = _sliding_sql()
    q["sliding_aggregate_panes"] = _sliding_sql()
    return q
