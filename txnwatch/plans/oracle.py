"""The same queries as plain SQL over the same tables, as an independent check."""

from __future__ import annotations

DAY_MS = 86_400_000

TXNS = """
txns AS (
  SELECT event_id, ts AS event_ts, epoch_us(ts) // 1000 AS event_ms,
         concat('txn-', event_id) AS transaction_id, concat('user-', user_id) AS user_id,
         CAST(round(value * 10000) AS BIGINT) AS amount, 'KRW' AS currency,
         CASE WHEN k % 20 < 16 THEN 'KR' WHEN k % 20 < 18 THEN 'US' WHEN k % 20 = 18 THEN 'JP' ELSE 'CN' END
           AS country_code,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS time_text
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)
)"""

ALERTS = TXNS + """,
alerts AS (
  SELECT md5(concat(transaction_id, '|', rule_name)) AS alert_id, *
  FROM (
    SELECT *, 'SIMPLE_RULE' AS rule_type, 'HIGH_VALUE' AS rule_name, 'HIGH' AS severity,
           concat('고액 거래 (100만원 초과): ', format('{:,}', amount), '원') AS reason
    FROM txns WHERE amount > 1000000
    UNION ALL
    SELECT *, 'SIMPLE_RULE', 'FOREIGN_COUNTRY', 'MEDIUM', concat('해외 거래 탐지 (국가: ', country_code, ')')
    FROM txns WHERE country_code <> 'KR'
  )
)"""

HISTORY = ALERTS + """,
history AS (
  SELECT alert_id, transaction_id, event_id, user_id, amount, currency, country_code, rule_name, reason, severity,
         event_ts AS alert_timestamp, event_ms AS alert_ms,
         CASE WHEN event_id % 10 < 6 THEN 'UNREAD' WHEN event_id % 10 < 8 THEN 'IN_PROGRESS' ELSE 'COMPLETED' END
           AS status,
         CASE WHEN event_id % 10 >= 6 THEN concat('agent-', event_id % 7) END AS assigned_to,
         CAST(NULL AS VARCHAR) AS action_note,
         CASE WHEN event_id % 10 >= 8 THEN event_ts + INTERVAL 1 MINUTE END AS processed_at
  FROM alerts
)"""

FLAT = "alert_id, transaction_id, user_id, amount, rule_type, rule_name, severity, reason, time_text AS alert_timestamp"


def _commands(alert_id: str) -> str:
    return f"""
commands AS (
  SELECT event_id AS seq, ts, epoch_us(ts) // 1000 AS ts_ms, {alert_id} AS alert_id,
         CASE event_type WHEN 'view' THEN 'ASSIGN' WHEN 'signup' THEN 'ACTION' ELSE 'STATUS' END AS cmd,
         CASE event_type WHEN 'click' THEN 'IN_PROGRESS' WHEN 'purchase' THEN 'COMPLETED' WHEN 'error' THEN 'UNREAD'
           END AS status,
         CASE WHEN event_type = 'view' AND event_id % 11 <> 0 THEN concat('agent-', user_id) END AS assigned_to,
         CASE WHEN event_type = 'signup' THEN CASE WHEN event_id % 13 = 0 THEN '' ELSE concat('note ', event_id) END
           END AS action_note,
         event_type = 'signup' AND event_id % 5 = 0 AS complete
  FROM events
),
effects AS (
  SELECT seq, ts, ts_ms, alert_id, cmd,
         CASE WHEN cmd = 'STATUS' THEN status WHEN cmd = 'ACTION' AND complete THEN 'COMPLETED' END AS set_status,
         CASE WHEN cmd = 'ASSIGN' THEN {{'to': assigned_to}} END AS set_assignee,
         CASE WHEN cmd = 'ACTION' THEN action_note END AS set_note
  FROM commands
  WHERE (cmd = 'STATUS' AND status IS NOT NULL)
     OR (cmd = 'ASSIGN' AND (assigned_to IS NULL OR length(assigned_to) <= 100))
     OR (cmd = 'ACTION' AND length(action_note) BETWEEN 1 AND 2000)
)"""


ON_CASES = _commands("concat('case-', event_id % 200)")
ON_ALERTS = _commands("md5(concat('txn-', event_id - event_id % 7, '|FOREIGN_COUNTRY'))")

# state of a known alert after each accepted command
STATES = HISTORY + "," + ON_ALERTS + """,
opened AS (
  SELECT alert_id, -1 AS seq, CAST(NULL AS BIGINT) AS ts_ms, NULL AS cmd, status AS set_status,
         {'to': assigned_to} AS set_assignee, action_note AS set_note,
         epoch_us(processed_at) // 1000 AS done_ms
  FROM history
  UNION ALL
  SELECT alert_id, seq, ts_ms, cmd, set_status, set_assignee, set_note,
         CASE WHEN set_status = 'COMPLETED' THEN ts_ms END
  FROM effects WHERE alert_id IN (SELECT alert_id FROM history)
),
states AS (
  SELECT alert_id, seq, cmd,
         last_value(set_status IGNORE NULLS) OVER w AS status,
         (last_value(set_assignee IGNORE NULLS) OVER w)['to'] AS assigned_to,
         last_value(set_note IGNORE NULLS) OVER w AS action_note,
         first_value(done_ms IGNORE NULLS) OVER w AS processed_ms
  FROM opened
  WINDOW w AS (PARTITION BY alert_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)"""

_ISO_MS = "strftime(make_timestamp({} * 1000), '%Y-%m-%dT%H:%M:%S.%gZ')"


def _json_text(*parts: str) -> str:
    return "concat(" + ", ".join(parts) + ")"


_TXN_JSON = _json_text(
    """'{"schemaVersion":"1.0","transactionId":"'""", "transaction_id", """'","userId":"'""", "user_id",
    """'","amount":'""", "amount", """',"currency":"KRW","countryCode":"'""", "country_code",
    """'","timestamp":"'""", "time_text", """'"}'""",
)

SEARCH = """rule_name = 'HIGH_VALUE' AND status = 'UNREAD'
  AND alert_timestamp >= TIMESTAMP '2024-01-24' AND alert_timestamp <= TIMESTAMP '2024-01-31'"""
PAGE = "alert_id, transaction_id, user_id, amount, rule_name, severity, status, alert_ms"

RECENT = HISTORY + """,
recent AS (
  SELECT *, row_number() OVER (ORDER BY alert_timestamp DESC, alert_id DESC) AS position FROM history
  QUALIFY position <= 100
)"""
LISTED = "alert_id, user_id, rule_name, severity, status, assigned_to"

TPS = TXNS + """,
counts AS (SELECT event_ms - event_ms % 300000 AS point_ms, count(*) AS n FROM txns GROUP BY 1),
grid AS (SELECT unnest(generate_series(min(point_ms), max(point_ms), 300000)) AS point_ms FROM counts),
tps AS (
  SELECT point_ms, coalesce(n, 0) AS n, coalesce(n, 0) // 5 AS tps,
         CAST(sum(coalesce(n, 0)) OVER (ORDER BY point_ms) AS BIGINT) AS total_transactions
  FROM grid LEFT JOIN counts USING (point_ms)
)"""


def _rates(high_value: bool = True) -> str:
    rule_json = (
        """concat('{"HIGH_VALUE":', hv, ',"FOREIGN_COUNTRY":', fc, ',"HIGH_FREQUENCY":0}')"""
        if high_value
        else """concat('{"FOREIGN_COUNTRY":', fc, ',"HIGH_FREQUENCY":0}')"""
    )
    keep = "TRUE" if high_value else "rule_name <> 'HIGH_VALUE'"
    return f"""
shown AS (SELECT * FROM history WHERE {keep}),
ends AS (
  SELECT min(alert_ms - alert_ms % 300000) + 300000 AS lo, max(alert_ms - alert_ms % 300000) + 3600000 AS hi FROM shown
),
samples AS (SELECT unnest(generate_series(lo, hi, 300000)) AS point_ms FROM ends),
rates AS (
  SELECT point_ms, hv + fc AS alerts_per_minute, hv, fc, {rule_json} AS by_rule
  FROM (
    SELECT point_ms, count(*) FILTER (rule_name = 'HIGH_VALUE') AS hv,
           count(*) FILTER (rule_name = 'FOREIGN_COUNTRY') AS fc
    FROM samples LEFT JOIN shown ON alert_ms >= point_ms - 3600000 AND alert_ms < point_ms
    GROUP BY point_ms
  )
)"""


RATES = HISTORY + "," + _rates()
_STATUS_AS_OF = "epoch_ms(TIMESTAMP '2024-01-29')"

SERVICES = """
beats AS (
  SELECT CASE user_id % 5 WHEN 0 THEN 'transaction-generator' WHEN 1 THEN 'fraud-detector' WHEN 2 THEN 'alert-service'
                          WHEN 3 THEN 'websocket-gateway' ELSE 'frontend-dashboard' END AS service_name,
         ts AS checked_at, event_id AS seq, CAST(round(value * 30) AS BIGINT) AS response_ms, event_type <> 'error' AS ok
  FROM events WHERE ts <= TIMESTAMP '2024-01-29'
),
newest AS (
  SELECT * FROM beats QUALIFY row_number() OVER (PARTITION BY service_name ORDER BY checked_at DESC, seq DESC) = 1
),
judged AS (
  SELECT service_name, checked_at, response_ms,
         CASE WHEN checked_at IS NULL OR checked_at < TIMESTAMP '2024-01-28 23:00:00' THEN 'NETWORK_ERROR'
              WHEN NOT ok THEN 'HTTP_ERROR' WHEN response_ms > 2000 THEN 'TIMEOUT' END AS error_type
  FROM (VALUES ('transaction-generator'), ('fraud-detector'), ('alert-service'), ('websocket-gateway'),
               ('frontend-dashboard')) s(service_name) LEFT JOIN newest USING (service_name)
),
services AS (
  SELECT service_name, CASE WHEN error_type IS NULL THEN 'UP' ELSE 'DOWN' END AS status,
         epoch_us(checked_at) // 1000 AS checked_ms, CASE WHEN error_type IS NULL THEN response_ms END AS response_time,
         error_type
  FROM judged
)"""

LATENCIES = HISTORY + """,
lat AS (
  SELECT h.alert_id, ((event_id * 37) % 12000 - 500) * 1000 AS us FROM history h
),
took AS (SELECT alert_id, us FROM lat WHERE us >= 0),
ranked AS (SELECT us, row_number() OVER (ORDER BY us) - 1 AS pos, count(*) OVER () AS n FROM took)"""


# the same with time running 4,000 times faster
FAST = TXNS.replace("txns AS (", "slow AS (") + """,
txns AS (
  SELECT * REPLACE (fast_ms AS event_ms, make_timestamp(fast_ms * 1000) AS event_ts,
                    strftime(make_timestamp(fast_ms * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') AS time_text)
  FROM (SELECT *, 1704067200000 + (event_ms - 1704067200000) // 4000 AS fast_ms FROM slow)
)"""


def _frequency(window_ms: int, threshold: int, span: str, txns: str = TXNS) -> str:
    return txns + f""",
counted AS (
  SELECT *, count(DISTINCT event_ms) OVER (
           PARTITION BY user_id ORDER BY event_ms RANGE BETWEEN {window_ms} PRECEDING AND CURRENT ROW) AS n
  FROM txns
),
frequent AS (
  SELECT *, md5(concat(transaction_id, '|HIGH_FREQUENCY')) AS alert_id, 'STATEFUL_RULE' AS rule_type,
         'HIGH_FREQUENCY' AS rule_name, 'HIGH' AS severity,
         concat('빈번한 거래 ({span} 내 {threshold}회 초과): ', user_id, ', ', n, '회') AS reason
  FROM counted WHERE n > {threshold}
)"""


def _countries(window_ms: int, span: str, txns: str = TXNS) -> str:
    return f"""WITH {txns}, seen AS (
              SELECT *, list_sort(list_distinct(list(country_code) OVER (PARTITION BY user_id ORDER BY event_ms
                       RANGE BETWEEN {window_ms} PRECEDING AND CURRENT ROW))) AS countries FROM txns),
            hit AS (SELECT *, md5(concat(transaction_id, '|MULTI_COUNTRY')) AS alert_id, 'STATEFUL_RULE' AS rule_type,
                      'MULTI_COUNTRY' AS rule_name, 'HIGH' AS severity,
                      concat('다중 국가 거래 ({span} 내 ', len(countries), '개 국가): ', array_to_string(countries, ', '))
                        AS reason FROM seen WHERE len(countries) >= 3)
            SELECT {FLAT} FROM hit"""


def _tumbling(closed: str) -> str:
    return f"""WITH {TXNS}, c AS (
          SELECT *, count(*) OVER d AS n, row_number() OVER (PARTITION BY user_id, event_ms // {DAY_MS}
                 ORDER BY event_ms DESC, transaction_id DESC) AS r
          FROM txns WINDOW d AS (PARTITION BY user_id, event_ms // {DAY_MS})),
        frequent AS (SELECT *, md5(concat(transaction_id, '|HIGH_FREQUENCY')) AS alert_id, 'STATEFUL_RULE' AS rule_type,
          'HIGH_FREQUENCY' AS rule_name, 'HIGH' AS severity,
          concat('빈번한 거래 (24시간 내 3회 초과): ', user_id, ', ', n, '회') AS reason FROM c WHERE n > 3 AND r = 1 AND {closed})
        SELECT {FLAT} FROM frequent"""


def _all_alerts() -> str:
    frequent = _frequency(DAY_MS, 5, "24시간")[len(TXNS):]
    return f"WITH {ALERTS}{frequent} SELECT {FLAT} FROM alerts UNION ALL SELECT {FLAT} FROM frequent"


def _rollup(unit: str) -> str:
    return f"""WITH {HISTORY} SELECT strftime(date_trunc('{unit}', alert_timestamp), '%Y-%m-%d') AS period, rule_name,
        count(*) AS n, count(*) FILTER (status = 'COMPLETED') AS completed FROM history GROUP BY 1, 2"""


def _hours(condition: str) -> str:
    return f"""WITH {HISTORY}, c AS (SELECT hour(alert_timestamp) AS hour, count(*) AS n FROM history
        WHERE {condition} GROUP BY 1)
        SELECT g.hour AS hour, coalesce(n, 0) AS n FROM (SELECT unnest(range(24)) AS hour) g LEFT JOIN c USING (hour)"""


def _rule_counts(low: str, high: str) -> str:
    return f"""WITH {HISTORY}, r AS (
        SELECT rule_name, count(*) AS n, count(*) FILTER (status = 'COMPLETED') AS completed FROM history
        WHERE alert_timestamp >= TIMESTAMP '{low}' AND alert_timestamp <= TIMESTAMP '{high}' GROUP BY 1) """


_VIOLATIONS = f"""WITH {HISTORY}, rough AS (
  SELECT alert_id, transaction_id, user_id, amount - 300000 AS amount,
         reason[1:5 + (amount - 300000) % 20] AS reason,
         CASE WHEN event_id % 17 = 0 THEN 'krw' ELSE currency END AS currency,
         CASE WHEN event_id % 13 = 0 THEN 'K' ELSE country_code END AS country_code,
         CASE WHEN event_id % 3 <> 0 THEN processed_at END AS processed_at,
         CASE WHEN event_id % 11 = 0 THEN 1990 + event_id % 20 END AS note_length,
         CASE WHEN event_id % 19 = 0 THEN 'CRITICAL' ELSE severity END AS severity,
         CASE WHEN event_id % 23 = 0 THEN 'DONE' ELSE status END AS status,
         CASE WHEN event_id % 29 <> 0 THEN rule_name END AS rule_name, alert_timestamp
  FROM history)
SELECT alert_id, concat_ws(',',
    CASE WHEN NOT amount > 0 THEN 'AMOUNT_NOT_POSITIVE' END,
    CASE WHEN length(reason) NOT BETWEEN 10 AND 1000 THEN 'REASON_LENGTH' END,
    CASE WHEN currency = 'krw' THEN 'CURRENCY_FORMAT' END,
    CASE WHEN country_code = 'K' THEN 'COUNTRY_FORMAT' END,
    CASE WHEN alert_timestamp > TIMESTAMP '2024-01-28' THEN 'ALERT_IN_FUTURE' END,
    CASE WHEN status = 'COMPLETED' AND processed_at IS NULL THEN 'COMPLETED_WITHOUT_TIME' END,
    CASE WHEN note_length > 2000 THEN 'NOTE_TOO_LONG' END,
    CASE WHEN severity = 'CRITICAL' THEN 'SEVERITY_UNKNOWN' END,
    CASE WHEN status = 'DONE' THEN 'STATUS_UNKNOWN' END,
    CASE WHEN rule_name IS NULL THEN 'MISSING_FIELD' END) AS violations FROM rough"""

_MATCHES = f"""{TXNS}, matched AS (
  SELECT *, 'r1' AS rule_id, 'ABOVE_900K' AS rule_name, 'CRITICAL' AS severity,
         concat('90만원을 넘는 거래: ', format('{{:,}}', amount), '원') AS reason FROM txns WHERE amount > 900000
  UNION ALL SELECT *, 'r2', 'WATCHED_COUNTRY', 'MEDIUM', concat('감시 국가 거래: ', country_code)
    FROM txns WHERE country_code IN ('US', 'CN')
  UNION ALL SELECT *, 'r4', 'SMALL_VALUE', 'LOW', concat('소액 거래: ', format('{{:,}}', amount), '원')
    FROM txns WHERE amount < 50000
  UNION ALL SELECT *, 'r5', 'NOT_HOME', 'HIGH', concat('국외 거래: ', country_code) FROM txns WHERE country_code <> 'KR')"""


def _arrivals(order: str) -> str:
    """The frequency rule row by row: a time leaves when a row comes whose window is past it."""
    return f"""WITH {TXNS},
        o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {order}) AS place FROM txns),
        g AS (SELECT a.user_id, a.place, min(b.place) AS leaves FROM o a JOIN o b
              ON a.user_id = b.user_id AND b.place > a.place AND b.event_ms > a.event_ms + {DAY_MS} GROUP BY 1, 2),
        k AS (SELECT o.user_id, o.place, event_ms, coalesce(leaves, 1000000000) AS leaves FROM o LEFT JOIN g USING (user_id, place)),
        c AS (SELECT b.event_id, count(DISTINCT a.event_ms) AS n FROM k a JOIN o b
              ON a.user_id = b.user_id AND a.place <= b.place AND b.place < a.leaves GROUP BY 1),
        frequent AS (SELECT txns.*, md5(concat(transaction_id, '|HIGH_FREQUENCY')) AS alert_id, 'STATEFUL_RULE' AS rule_type,
          'HIGH_FREQUENCY' AS rule_name, 'HIGH' AS severity,
          concat('빈번한 거래 (24시간 내 5회 초과): ', user_id, ', ', n, '회') AS reason FROM txns JOIN c USING (event_id) WHERE n > 5)
        SELECT {FLAT} FROM frequent"""


def _watermark(batch: str) -> str:
    return f"""WITH {TXNS}, b AS (SELECT *, {batch} AS batch FROM txns),
        m AS (SELECT batch, max(event_ms) AS top FROM b GROUP BY 1),
        w AS (SELECT batch, max(top) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 7200000 AS edge FROM m),
        r AS (SELECT event_ms - event_ms % 3600000 AS point_ms, coalesce(event_ms < edge, FALSE) AS late FROM b JOIN w USING (batch))
        SELECT point_ms, count(*) FILTER (NOT late) AS n_kept, count(*) FILTER (late) AS n_late FROM r GROUP BY 1"""


def oracles() -> dict[str, str]:
    found = {
        "decode_quarantine": f"""WITH {TXNS}, r AS (
            SELECT event_id AS "offset",
                   CASE WHEN event_id % 97 = 0 THEN 'BAD_JSON' WHEN event_id % 83 = 0 THEN 'MISSING_FIELD: userId' END
                     AS problem, * FROM txns)
            SELECT "offset", problem, CASE WHEN problem IS NULL THEN transaction_id END AS transaction_id,
                   CASE WHEN problem IS NULL THEN user_id END AS user_id,
                   CASE WHEN problem IS NULL THEN event_ms END AS event_ms,
                   CASE WHEN problem IS NULL THEN TRUE END AS time_ok,
                   CASE WHEN problem IS NULL THEN event_id % 89 <> 0 END AS schema_ok,
                   CASE WHEN problem IS NULL THEN event_id % 89 <> 0 AND amount BETWEEN 1000 AND 1500000
                     AND regexp_full_match(user_id, 'user-(10|[1-9])') END AS is_valid FROM r""",
        "txn_validity": f"""WITH {TXNS} SELECT transaction_id, TRUE AS schema_ok,
            amount BETWEEN 1000 AND 1500000 AND regexp_full_match(user_id, 'user-(10|[1-9])') AS is_valid,
            regexp_full_match(user_id, 'user-(10|[1-9])') AS user_ok, FALSE AS uuid_ok, concat(format('{{:,}}', amount), '원') AS amount_text,
            strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS time_text FROM txns""",
        "transaction_records": f"WITH {TXNS} SELECT user_id AS key, {_TXN_JSON} AS value FROM txns",
        "alert_records": f"""WITH {ALERTS} SELECT user_id AS key,
            concat('{{"schemaVersion":"1.0","alertId":"', alert_id, '","originalTransaction":', {_TXN_JSON},
                   ',"ruleType":"', rule_type, '","ruleName":"', rule_name, '","reason":"', reason, '","severity":"',
                   severity, '","alertTimestamp":"', time_text, '"}}') AS value,
            concat('schema-version=1.0;source-service=fraud-detector;rule-name=', rule_name) AS headers FROM alerts""",
        "decoded_alerts": f"WITH {ALERTS} SELECT {FLAT} FROM alerts",
        "high_value_alerts": f"""WITH {ALERTS} SELECT {FLAT}, concat('[HIGH] ', user_id, ': ', reason) AS summary
            FROM alerts WHERE rule_name = 'HIGH_VALUE'""",
        "foreign_country_alerts": f"""WITH {ALERTS} SELECT {FLAT}, concat('[MEDIUM] ', user_id, ': ', reason) AS summary
            FROM alerts WHERE rule_name = 'FOREIGN_COUNTRY'""",
        "high_frequency_alerts": f"WITH {_frequency(DAY_MS, 5, '24시간')} SELECT {FLAT} FROM frequent",
        "high_frequency_short": f"WITH {_frequency(7_200_000, 1, '2시간')} SELECT {FLAT} FROM frequent",
        "multi_country_alerts": _countries(DAY_MS, "24시간"),
        "multi_country_default": _countries(600_000, "10분", FAST),
        "high_frequency_default": f"WITH {_frequency(60_000, 5, '1분', FAST)} SELECT {FLAT} FROM frequent",
        "high_frequency_tumbling": _tumbling("TRUE"),
        "stream_tumbling": _tumbling("TRUE"),
        "all_alerts": _all_alerts(),
        "alert_validity": f"""WITH {ALERTS} SELECT alert_id, amount BETWEEN 1000 AND 1500000
              AND regexp_full_match(user_id, 'user-(10|[1-9])') AS is_valid, TRUE AS in_order FROM alerts""",
        "dynamic_rule_matches": f"""WITH {_MATCHES} SELECT md5(concat(transaction_id, '|', rule_name)) AS alert_id,
            transaction_id, user_id, amount, 'SIMPLE_RULE' AS rule_type, rule_name, severity, reason,
            time_text AS alert_timestamp FROM matched""",
        "rule_validation": f"""WITH {_MATCHES}, c AS (SELECT rule_id, count(*) AS n FROM matched GROUP BY 1)
            SELECT rule_id, violations, coalesce(n, 0) AS n FROM (VALUES ('r1', ''), ('r2', ''), ('r3', ''), ('r4', ''),
              ('r5', ''), ('r6', 'BAD_OPERATOR'), ('r7', 'BAD_FIELD'),
              ('r8', 'BAD_JSON,BAD_FIELD,BAD_OPERATOR,BAD_VALUE'), ('r9', 'BAD_VALUE'), ('r10', 'DUPLICATE_NAME'),
              ('r11', 'DUPLICATE_NAME'), ('r12', 'BAD_TYPE'), ('r13', 'BAD_TYPE')) v(rule_id, violations)
            LEFT JOIN c USING (rule_id)""",
        "rule_dry_run": f"""WITH {TXNS} SELECT transaction_id, user_id = 'user-7' AS matched,
            CASE WHEN user_id = 'user-7' THEN '매칭됨 - 감시 사용자: user-7' ELSE '매칭 안됨' END AS result FROM txns""",
        "flatten_history": f"""WITH {ALERTS} SELECT alert_id, '1.0' AS schema_version, transaction_id, user_id, amount,
            currency, country_code, rule_name, reason, severity, event_ms AS alert_ms, 'UNREAD' AS status,
            CAST(NULL AS VARCHAR) AS assigned_to, CAST(NULL AS VARCHAR) AS action_note, CAST(NULL AS BIGINT) AS processed_ms,
            epoch_ms(TIMESTAMP '2024-01-31') AS created_ms FROM alerts""",
        "history_violations": _VIOLATIONS,
        "history_search_page": f"""WITH {HISTORY} SELECT {PAGE} FROM history WHERE {SEARCH}
            ORDER BY alert_timestamp DESC, alert_id LIMIT 20 OFFSET 20""",
        "history_search_user": f"""WITH {HISTORY} SELECT {PAGE} FROM history WHERE user_id = 'user-7'
            AND alert_timestamp >= TIMESTAMP '2024-01-05' AND alert_timestamp <= TIMESTAMP '2024-01-20 23:59:59.999'
            ORDER BY alert_timestamp DESC, alert_id LIMIT 100""",
        "history_page_meta": f"""WITH {HISTORY}, t AS (SELECT count(*) AS n FROM history WHERE {SEARCH})
            SELECT n AS total_elements, (n + 19) // 20 AS total_pages, CAST(1 AS BIGINT) AS current_page,
            CAST(20 AS BIGINT) AS page_size, 1 < (n + 19) // 20 - 1 AS has_next, TRUE AS has_previous FROM t""",
        "history_page_sorted": f"""WITH {HISTORY}, p AS (SELECT {PAGE} FROM history WHERE {SEARCH}
            ORDER BY alert_timestamp DESC, alert_id LIMIT 20 OFFSET 20)
            SELECT *, row_number() OVER (ORDER BY amount DESC, alert_id) AS position FROM p""",
        "latest_history": f"""WITH {HISTORY} SELECT {PAGE} FROM history ORDER BY alert_timestamp DESC, alert_id LIMIT 10""",
        "history_append": f"""WITH {HISTORY} SELECT strftime(alert_timestamp, '%Y-%m-%d') AS alert_date, count(*) AS n,
            CAST(sum(amount) AS BIGINT) AS total_amount, min(alert_id) AS first_id FROM history GROUP BY 1""",
        "archive_split": f"""WITH {HISTORY} SELECT
            CASE WHEN alert_timestamp >= TIMESTAMP '2024-01-21' THEN 'kept' ELSE 'archived' END AS part,
            strftime(alert_timestamp, '%Y-%m') AS alert_month, count(*) AS n, CAST(sum(amount) AS BIGINT) AS total_amount
            FROM history GROUP BY 1, 2""",
        "retention": f"""WITH {HISTORY}, k AS (
              SELECT 'transactions' AS kind, event_ms FROM txns WHERE event_ts >= TIMESTAMP '2024-01-19 23:00:00'
              UNION ALL SELECT 'alerts', alert_ms FROM history WHERE alert_timestamp >= TIMESTAMP '2024-01-19')
            SELECT kind, count(*) AS n, min(event_ms) AS first_ms FROM k GROUP BY 1""",
        "recent_alerts": f"WITH {RECENT} SELECT alert_id, user_id, rule_name, position FROM recent",
        "recent_filtered": f"WITH {RECENT} SELECT {LISTED} FROM recent WHERE status = 'UNREAD' AND severity = 'MEDIUM'",
        "recent_first_filter": f"WITH {RECENT} SELECT {LISTED} FROM recent WHERE assigned_to = 'agent-5'",
        "severity_sorted": f"""WITH {RECENT} SELECT alert_id, severity,
            CASE severity WHEN 'HIGH' THEN '높음' ELSE '보통' END AS severity_name,
            CASE status WHEN 'UNREAD' THEN '미확인' WHEN 'IN_PROGRESS' THEN '확인중' ELSE '완료' END AS status_name,
            row_number() OVER (ORDER BY CASE severity WHEN 'HIGH' THEN 3 ELSE 2 END DESC, alert_timestamp DESC,
              alert_id DESC) AS position FROM recent""",
        "alert_display": f"""WITH {HISTORY} SELECT alert_id, CASE WHEN status <> 'COMPLETED' THEN status END AS status,
            CASE status WHEN 'UNREAD' THEN '미확인' WHEN 'IN_PROGRESS' THEN '확인중' END AS status_name, rule_name,
            CAST(CASE severity WHEN 'HIGH' THEN 3 ELSE 2 END AS BIGINT) AS priority,
            epoch_ms(date_trunc('day', alert_timestamp)::TIMESTAMP) AS day_start_ms,
            epoch_ms(date_trunc('day', alert_timestamp)::TIMESTAMP) + 86399999 AS day_end_ms FROM history""",
        "point_lookup": f"""WITH {HISTORY} SELECT {LISTED} FROM history
            WHERE alert_id = '2e583b9f89eebf6e344fe232716e1a09'""",
        "status_fold": f"""WITH {ON_CASES}, s AS (
              SELECT *, last_value(set_status IGNORE NULLS) OVER w AS status,
                     (last_value(set_assignee IGNORE NULLS) OVER w)['to'] AS assigned_to,
                     last_value(set_note IGNORE NULLS) OVER w AS action_note,
                     min(CASE WHEN set_status = 'COMPLETED' THEN ts_ms END) OVER w AS processed_ms,
                     count(*) OVER w AS n_commands, row_number() OVER (PARTITION BY alert_id ORDER BY ts DESC, seq DESC) AS r
              FROM effects WINDOW w AS (PARTITION BY alert_id ORDER BY ts, seq
                ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
            SELECT alert_id, status, assigned_to, action_note, processed_ms, n_commands FROM s WHERE r = 1""",
        "status_events": f"""WITH {STATES} SELECT alert_id, seq, cmd, status, assigned_to, action_note, processed_ms
            FROM states WHERE cmd IS NOT NULL""",
        "status_event_records": f"""WITH {STATES} SELECT alert_id AS key,
            concat('{{"alertId":"', alert_id, '","status":"', status, '"',
              CASE WHEN processed_ms IS NULL THEN '' ELSE concat(',"processedAt":"', {_ISO_MS.format('processed_ms')}, '"') END,
              CASE WHEN assigned_to IS NULL THEN '' ELSE concat(',"assignedTo":"', assigned_to, '"') END,
              CASE WHEN action_note IS NULL THEN '' ELSE concat(',"actionNote":"', action_note, '"') END, '}}') AS value
            FROM states WHERE cmd IS NOT NULL""",
        "case_state": f"""WITH {STATES} SELECT alert_id, status, assigned_to, action_note, processed_ms FROM states
            QUALIFY row_number() OVER (PARTITION BY alert_id ORDER BY seq DESC) = 1""",
        "apply_status_changes": f"""WITH {STATES}, s AS (
              SELECT alert_id, seq, status, last_value(assigned_to IGNORE NULLS) OVER w AS assigned_to,
                     last_value(action_note IGNORE NULLS) OVER w AS action_note,
                     last_value(processed_ms IGNORE NULLS) OVER w AS processed_ms
              FROM states WINDOW w AS (PARTITION BY alert_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
            SELECT alert_id, status, assigned_to, action_note, processed_ms FROM s
            QUALIFY row_number() OVER (PARTITION BY alert_id ORDER BY seq DESC) = 1""",
        "new_alerts_only": f"""WITH {HISTORY} SELECT alert_id, rule_name, user_id FROM history
            WHERE alert_timestamp >= TIMESTAMP '2024-01-15'""",
        "status_counts": f"""WITH {HISTORY} SELECT status, count(*) AS n FROM history
            WHERE alert_timestamp >= TIMESTAMP '2024-01-10' GROUP BY 1""",
        "hourly_counts": _hours("alert_timestamp >= TIMESTAMP '2024-01-17' AND alert_timestamp < TIMESTAMP '2024-01-18'"),
        "hourly_counts_last_day": _hours(
            "alert_timestamp > TIMESTAMP '2024-01-16 13:30:00' AND alert_timestamp <= TIMESTAMP '2024-01-17 13:30:00'"
        ),
        "rule_stats": _rule_counts("2024-01-03", "2024-01-31")
        + """SELECT rule_name, n, n * 100.0::DOUBLE / sum(n) OVER () AS percentage, completed,
             completed * 100.0::DOUBLE / n AS completion_rate FROM r""",
        "report_csv": _rule_counts("2024-01-05", "2024-01-20 23:59:59.999")
        + "SELECT rule_name, n, completed FROM r",
        "rule_coverage": f"""WITH {HISTORY}, c AS (SELECT rule_name, count(*) AS n FROM history GROUP BY 1)
            SELECT rule_name, coalesce(n, 0) AS n, n IS NOT NULL AS fired
            FROM (VALUES ('HIGH_VALUE'), ('FOREIGN_COUNTRY'), ('HIGH_FREQUENCY')) v(rule_name) LEFT JOIN c USING (rule_name)""",
        "txn_profile": f"""WITH {TXNS} SELECT country_code, count(*) AS n, min(amount) AS min_amount,
            max(amount) AS max_amount, count(DISTINCT user_id) AS users,
            count(*) FILTER (amount NOT BETWEEN 1000 AND 1500000) AS outside_range,
            count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS percentage FROM txns GROUP BY 1""",
        "latency_stats": f"""WITH {LATENCIES} SELECT count(*) AS n, min(us) / 1e6::DOUBLE AS min_s,
            CAST(sum(us) AS DOUBLE) / count(*) / 1e6::DOUBLE AS mean_s,
            max(CASE WHEN pos = floor(n * 0.95::DOUBLE) THEN us END) / 1e6::DOUBLE AS p95_s,
            max(CASE WHEN pos = floor(n * 0.99::DOUBLE) THEN us END) / 1e6::DOUBLE AS p99_s,
            max(us) / 1e6::DOUBLE AS max_s FROM ranked""",
        "latency_histogram": f"""WITH {LATENCIES}, x AS (SELECT CAST(printf('%.2f', us / 1e6::DOUBLE) AS DOUBLE) AS s FROM took),
            c AS (SELECT CASE WHEN s < 1 THEN '0-1' WHEN s < 2 THEN '1-2' WHEN s < 3 THEN '2-3' WHEN s < 5 THEN '3-5'
                              WHEN s < 10 THEN '5-10' ELSE '10+' END AS bucket, count(*) AS n FROM x GROUP BY 1)
            SELECT bucket, coalesce(n, 0) AS n, coalesce(n, 0) * 100.0::DOUBLE / sum(n) OVER () AS percentage
            FROM (VALUES ('0-1'), ('1-2'), ('2-3'), ('3-5'), ('5-10'), ('10+')) v(bucket) LEFT JOIN c USING (bucket)""",
        "latency_unmatched": f"""WITH {HISTORY} SELECT alert_id, transaction_id FROM history
            WHERE alert_timestamp < TIMESTAMP '2024-01-03'""",
        "tps_series": f"WITH {TPS} SELECT * FROM tps",
        "alert_rate_series": f"WITH {RATES} SELECT point_ms, alerts_per_minute, by_rule FROM rates",
        "alert_rate_visible": f"""WITH {HISTORY}, {_rates(False)} SELECT point_ms, alerts_per_minute, by_rule FROM rates""",
        "alert_warnings": f"""WITH {RATES}, a AS (SELECT point_ms, alerts_per_minute,
              avg(alerts_per_minute) OVER w AS average_value, max(alerts_per_minute) OVER w AS max_value FROM rates
              WINDOW w AS (ORDER BY point_ms RANGE BETWEEN 21600000 PRECEDING AND CURRENT ROW))
            SELECT *, alerts_per_minute > average_value * 2 AS is_warning FROM a""",
        "metrics_summary": f"""WITH {TPS}, {HISTORY[len(TXNS) + 1:]}, {_rates()},
            m AS (SELECT 'tps' AS metric, point_ms, n AS v FROM tps
                  UNION ALL SELECT 'alerts', point_ms, alerts_per_minute FROM rates)
            SELECT metric, arg_max(v, point_ms) AS current_value, avg(v) AS average_value, max(v) AS max_value FROM m
            WHERE point_ms > {_STATUS_AS_OF} - {DAY_MS} AND point_ms <= {_STATUS_AS_OF} GROUP BY 1""",
        "metric_backfill": f"""WITH {TPS} SELECT point_ms, n FROM tps
            WHERE point_ms > epoch_ms(TIMESTAMP '2024-01-28 12:00:00') AND point_ms <= {_STATUS_AS_OF}""",
        "metric_checks": f"""WITH {RATES}, s AS (SELECT *, (point_ms // 300000) % 10 AS slot FROM rates)
            SELECT CASE WHEN slot = 1 THEN point_ms + 7 ELSE point_ms END AS point_ms,
              CASE slot WHEN 2 THEN alerts_per_minute + 1 WHEN 3 THEN 1001 ELSE alerts_per_minute END AS alerts_per_minute,
              concat_ws(',',
                CASE WHEN slot = 1 THEN 'AM-001' END, CASE WHEN slot = 3 THEN 'AM-002' END,
                CASE WHEN slot = 4 THEN 'AM-003' END,
                CASE WHEN slot = 5 THEN 'AM-004' END,
                CASE WHEN slot IN (2, 3, 5) OR (slot = 4 AND hv > 0) THEN 'AM-005' END) AS violations FROM s""",
        "tps_checks": f"""WITH {TPS}, s AS (SELECT *, (point_ms // 300000) % 7 AS slot FROM tps)
            SELECT CASE WHEN slot = 1 THEN point_ms + 7 ELSE point_ms END AS point_ms, CASE WHEN slot = 2 THEN -1 ELSE tps END AS tps,
              CASE WHEN slot = 3 THEN -5 ELSE total_transactions END AS total_transactions,
              CASE slot WHEN 1 THEN 'TM-001' WHEN 2 THEN 'TM-002' WHEN 3 THEN 'TM-003' ELSE '' END AS violations FROM s""",
        "service_checks": f"""WITH h AS (SELECT event_id AS seq, event_type <> 'error' AS ok, ts, CAST(round(value * 30) AS BIGINT) * 2 AS took,
              CASE WHEN event_id % 10 = 0 THEN 'other' ELSE CASE user_id % 5 WHEN 0 THEN 'transaction-generator' WHEN 1 THEN 'fraud-detector'
                WHEN 2 THEN 'alert-service' WHEN 3 THEN 'websocket-gateway' ELSE 'frontend-dashboard' END END AS service_name FROM events)
            SELECT seq, service_name, CASE WHEN ok THEN 'UP' ELSE 'DOWN' END AS status, concat_ws(',',
              CASE WHEN service_name = 'other' THEN 'SH-001' END,
              CASE WHEN epoch_us(ts) // 1000 < {_STATUS_AS_OF} - 10000 THEN 'SH-003' END,
              CASE WHEN ok AND NOT took BETWEEN 0 AND 5000 THEN 'SH-004' END,
              CASE WHEN ok AND seq % 9000 > 8192 THEN 'SH-005' END,
              CASE WHEN NOT ok AND seq % 3 <> 0 THEN 'SH-006' END,
              CASE WHEN NOT ok AND seq % 4 = 0 THEN 'SH-007' END) AS violations FROM h""",
        "history_length_checks": "SELECT 720 AS tps_points, 720 AS alert_points, '' AS violations",
        "service_status": f"WITH {SERVICES} SELECT * FROM services",
        "metrics_snapshot": f"""WITH {TPS}, {HISTORY[len(TXNS) + 1:]}, {_rates()}, {SERVICES},
            t AS (SELECT * FROM tps WHERE point_ms > {_STATUS_AS_OF} - 3600000 AND point_ms <= {_STATUS_AS_OF}),
            r AS (SELECT * FROM rates WHERE point_ms > {_STATUS_AS_OF} - 3600000 AND point_ms <= {_STATUS_AS_OF})
            SELECT 'METRICS_UPDATE' AS type, {_STATUS_AS_OF} AS at_ms,
              (SELECT string_agg(concat(service_name, '=', status), ',' ORDER BY service_name) FROM services) AS services,
              (SELECT arg_max(tps, point_ms) FROM t) AS tps_current, (SELECT avg(tps) FROM t) AS tps_average,
              (SELECT max(tps) FROM t) AS tps_max,
              (SELECT concat('[', string_agg(concat('{{"point_ms":', point_ms, ',"tps":', tps, ',"total_transactions":',
                 total_transactions, '}}'), ',' ORDER BY point_ms), ']') FROM t) AS tps_history,
              (SELECT arg_max(alerts_per_minute, point_ms) FROM r) AS alerts_current,
              (SELECT avg(alerts_per_minute) FROM r) AS alerts_average, (SELECT max(alerts_per_minute) FROM r) AS alerts_max,
              (SELECT arg_max(by_rule, point_ms) FROM r) AS alerts_by_rule,
              (SELECT string_agg(CAST(alerts_per_minute AS VARCHAR), ',' ORDER BY point_ms) FROM r) AS alerts_history""",
        "stream_tps": f"""WITH {TXNS}, h AS (SELECT event_ms - event_ms % 3600000 AS point_ms, count(*) AS n FROM txns GROUP BY 1)
            SELECT point_ms, n FROM h""",
        "stream_alert_rate": f"""WITH {ALERTS}, s AS (SELECT event_ms - event_ms % 1800000 AS half FROM alerts),
            h AS (SELECT half - d * 1800000 AS point_ms, count(*) AS n FROM s, (VALUES (0), (1)) v(d) GROUP BY 1)
            SELECT point_ms, n FROM h""",
        "stream_dedup_days": f"WITH {ALERTS} SELECT alert_id, user_id, rule_name, event_ms FROM alerts",
        "stream_arrival": _arrivals("event_id"),
        "stream_watermark": _watermark("0"),
        "stream_timers": f"""WITH {TXNS}, e AS (SELECT user_id, max(event_ms) - {DAY_MS} AS edge FROM txns GROUP BY 1),
            w AS (SELECT max(event_ms) - 5000 AS mark FROM txns),
            k AS (SELECT DISTINCT user_id, event_ms FROM txns JOIN e USING (user_id), w WHERE event_ms >= edge AND event_ms + {DAY_MS} >= mark)
            SELECT user_id, count(*) AS n_kept, min(event_ms) AS first_ms, max(event_ms) AS last_ms FROM k GROUP BY 1""",
        "stream_rules": f"""WITH {_MATCHES}, n AS (SELECT *, event_id % 5 AS file FROM matched)
            SELECT md5(concat(transaction_id, '|', rule_name)) AS alert_id, transaction_id, user_id, amount, 'SIMPLE_RULE' AS rule_type,
              rule_name, severity, reason, time_text AS alert_timestamp, CASE WHEN file < 2 THEN 13 WHEN file < 4 THEN 2 ELSE 1 END AS n_rules
            FROM n WHERE file < 2 OR (file < 4 AND rule_id IN ('r2', 'r4')) OR (file = 4 AND rule_id = 'r5')""",
        "stream_latency": f"WITH {LATENCIES} SELECT alert_id, us AS latency_us FROM took",
        "stream_dedup": f"WITH {ALERTS} SELECT alert_id, user_id, rule_name FROM alerts",
    }
    for unit in ("day", "week", "month"):
        found[f"period_rollup_{unit}"] = _rollup(unit)
    found["stream_detect"] = found["stream_detect_split"] = found["stream_restart"] = found["all_alerts"]
    # parts are slabs of at least a window; the newest one and the ten days before it are there
    found["stream_retained"] = f"""WITH x AS ({found["all_alerts"]}), y AS (SELECT *, epoch_ms(alert_timestamp::TIMESTAMP) AS ms FROM x),
        e AS (SELECT max(epoch_us(ts) // 1000) AS top FROM events)
        SELECT y.* EXCLUDE (ms) FROM y, e WHERE ms - ms % {DAY_MS} >= top - top % {DAY_MS} - 10 * {DAY_MS}"""
    found["history_append_days"] = found["history_append"]
    found["stream_live_list"] = f"""WITH {RECENT}, s AS ({found["apply_status_changes"]})
        SELECT s.* FROM s JOIN recent USING (alert_id)"""
    found["rule_csv"], found["hourly_csv"] = found["rule_stats"], found["hourly_counts"]
    found["archive_written"] = found["archive_split"]
    found["history_search_deep"] = found["history_search_stored"] = found["history_search_page"]
    found["stream_recent"] = found["recent_alerts"]
    found["stream_decode"] = found["decode_quarantine"]
    found["stream_cases"] = found["status_events"]
    found["stream_multi_country"] = found["multi_country_alerts"]
    runs = {"stream_timers", "stream_restart", "stream_rules", "stream_latency", "stream_live_list"}
    found |= {f"{name}_late": sql for name, sql in found.items() if name.startswith("stream_") and name not in runs}
    # one file a batch: the files are dealt by number
    found["stream_arrival_late"] = _arrivals("event_id % 5, event_id")
    found["stream_watermark_late"] = _watermark("event_id % 5")
    return found
