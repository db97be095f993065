"""The same queries as SQL over the `events` view, for an independent engine."""

from __future__ import annotations

from eventguard.operators import rules
from eventguard.plans import fixture
from eventguard.plans.fixture import HOT_TIME

_FORMAT = "'%Y-%m-%dT%H:%M:%SZ'"

TXN = f"""
base AS (
  SELECT event_id, mod(event_id, 100) AS b,
         'U' || cast(10000 + user_id AS varchar) AS u,
         cast(floor(value * 20000) + 1 AS double) AS amt,
         CASE event_type WHEN 'click' THEN 'web' WHEN 'signup' THEN 'web'
              WHEN 'purchase' THEN 'pos' ELSE 'mobile' END AS src,
         timestamp '2025-12-14 09:00:00' + event_id * interval '1' second AS arr
  FROM events),
shaped AS (
  SELECT event_id, b,
         CASE WHEN b IN (78, 79) THEN NULL ELSE u END AS user_id,
         CASE WHEN b IN (70, 71) THEN cast({fixture.TOO_LOW} AS double)
              WHEN b IN (72, 73) THEN cast({fixture.TOO_HIGH} AS double)
              WHEN b IN (80, 81) THEN NULL ELSE amt END AS amount,
         CASE WHEN b = 74 THEN '{fixture.NO_TIME}' WHEN b = 75 THEN ''
              WHEN b BETWEEN 82 AND 91
                THEN strftime(arr - (4 + mod(event_id, 7)) * interval '1' minute, {_FORMAT})
              ELSE strftime(arr, {_FORMAT}) END AS ts_text,
         CASE WHEN b IN (76, 77) THEN '{fixture.NO_SOURCE}' ELSE src END AS source, arr
  FROM base),
txn AS (
  SELECT s.event_id, s.event_id // 250 AS batch_id,
         CASE WHEN o.event_id IS NULL THEN s.user_id ELSE o.user_id END AS user_id,
         CASE WHEN o.event_id IS NULL THEN s.amount ELSE o.amount END AS amount,
         CASE WHEN o.event_id IS NULL THEN s.ts_text ELSE o.ts_text END AS ts_text,
         CASE WHEN o.event_id IS NULL THEN s.source ELSE o.source END AS source,
         s.arr AS ingest_ts
  FROM shaped s
  LEFT JOIN shaped o ON s.b BETWEEN 92 AND 99 AND o.event_id = s.event_id - 50),
timed AS (SELECT *, try_strptime(ts_text, {_FORMAT}) AS event_time FROM txn)"""

# All before `timed`, for queries that judge other records.
_BEFORE_TIME = TXN.rsplit("timed AS", 1)[0]

_MANDATORY = f"""
    WHEN user_id IS NULL OR trim(user_id) = '' THEN '{rules.USER_MISSING}'
    WHEN amount IS NULL THEN '{rules.AMOUNT_MISSING}'
    WHEN ts_text IS NULL OR trim(ts_text) = '' THEN '{rules.TIMESTAMP_MISSING}'
    WHEN source IS NULL OR trim(source) = '' THEN '{rules.SOURCE_MISSING}'"""
_TYPE = f"""
    WHEN event_time IS NULL THEN '{rules.TIMESTAMP_TYPE}'
    WHEN isnan(amount) THEN '{rules.AMOUNT_NAN}'"""
_RANGE = f"""
    WHEN amount < 1 OR amount > 10000000 THEN '{rules.AMOUNT_RANGE}'"""
_SOURCE = f"""
    WHEN source NOT IN ('mobile', 'web', 'pos') THEN '{rules.SOURCE_UNKNOWN}'"""
_LATE = f"""
    WHEN floor(epoch(ingest_ts)) - floor(epoch(event_time)) > 180 THEN '{rules.LATE}'"""

_JUDGED = f"""
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY batch_id, user_id, ts_text ORDER BY event_id) AS rn
  FROM timed),
judged AS (
  SELECT *, CASE {_MANDATORY} {_TYPE} {_RANGE} {_SOURCE}
    WHEN rn > 1 THEN '{rules.REPEAT_IN_BATCH}' {_LATE} END AS err1
  FROM ranked),
cls AS (
  SELECT *, error_reason IS NULL AS is_valid FROM (
    SELECT *, CASE WHEN err1 IS NULL AND row_number() OVER (
        PARTITION BY user_id, ts_text, CASE WHEN err1 IS NULL THEN 1 ELSE 0 END
        ORDER BY event_id) > 1
      THEN '{rules.REPEAT_ACROSS}' ELSE err1 END AS error_reason
    FROM judged))"""

CLS = f"{TXN}, {_JUDGED}"

# A third of the records under one key, and faults that `txn` does not have.
_SKEWED = f"""
timed AS (
  SELECT *, try_strptime(ts_text, {_FORMAT}) AS event_time FROM (
    SELECT event_id, batch_id, ingest_ts,
           CASE WHEN mod(event_id, 3) = 0 THEN 'U7' WHEN mod(event_id, 103) = 9 THEN '  '
                ELSE user_id END AS user_id,
           CASE WHEN mod(event_id, 3) = 0 THEN '{HOT_TIME}' ELSE ts_text END AS ts_text,
           CASE WHEN mod(event_id, 101) = 7 THEN 'nan'::double ELSE amount END AS amount,
           CASE WHEN mod(event_id, 97) = 5 THEN NULL WHEN mod(event_id, 89) = 4 THEN ' '
                ELSE source END AS source
    FROM txn))"""

# JSON lines with their faults, and what another parser makes of them. Of a repeated field the
# last one counts; an amount that is no number does not fit.
_RAW = f"""
odd AS (SELECT *, event_id % 40 AS m, cast(cast(amount AS bigint) AS varchar) AS amt FROM txn),
whole AS (
  SELECT *, '{{' || concat_ws(',',
    CASE WHEN m = {fixture.NUMBER} THEN '"user_id":' || event_id ELSE '"user_id":"' || user_id || '"' END,
    CASE WHEN m = {fixture.NAN} THEN '"amount":NaN' WHEN m = {fixture.QUOTED} THEN '"amount":"' || amt || '"'
         ELSE '"amount":' || amt END,
    '"timestamp":"' || ts_text || '"',
    CASE WHEN m = {fixture.NESTED} THEN '"source":{{"a":1}}' ELSE '"source":"' || source || '"' END,
    CASE WHEN m = {fixture.TWICE} THEN '"user_id":"U5"' END) || '}}' AS line
  FROM odd),
lines AS (
  SELECT event_id, batch_id, ingest_ts, CASE m
    WHEN {fixture.CUT} THEN left(line, length(line) - 9) WHEN {fixture.NO_COLONS} THEN replace(line, ':', '')
    WHEN {fixture.BLANK} THEN '' WHEN {fixture.LIST} THEN '[1,2]' WHEN {fixture.WORDS} THEN 'no record'
    WHEN {fixture.NOTHING} THEN NULL ELSE line END AS value
  FROM whole),
checked AS (
  SELECT *, coalesce(CASE WHEN json_valid(value) THEN json_type(value) = 'OBJECT' END, false) AS is_object FROM lines),
fields AS (
  SELECT event_id, key, max_by(value ->> '$', id) AS text, max_by(type, id) AS kind
  FROM (SELECT event_id, e.key, e.value, e.type, e.id
        FROM checked, LATERAL json_each(CASE WHEN is_object THEN value ELSE '{{}}' END) e)
  GROUP BY event_id, key),
decoded AS (
  SELECT event_id, max(text) FILTER (key = 'user_id') AS user_id, max(text) FILTER (key = 'timestamp') AS ts_text,
         max(text) FILTER (key = 'source') AS source,
         max(CASE WHEN key = 'amount' AND kind <> 'VARCHAR' THEN try_cast(text AS double) END) AS amount,
         coalesce(bool_or(key = 'amount' AND kind = 'VARCHAR'), false) AS misfit
  FROM fields GROUP BY event_id),
timed AS (
  SELECT c.event_id, batch_id, ingest_ts, value AS raw, NOT is_object OR coalesce(misfit, false) AS corrupt,
         user_id, amount, ts_text, source, try_strptime(ts_text, {_FORMAT}) AS event_time
  FROM checked c LEFT JOIN decoded USING (event_id))"""

_PLAIN_AMOUNT = """CASE WHEN NOT coalesce(isnan(amount), false) THEN amount END AS amount,
  coalesce(isnan(amount), false) AS amount_is_nan"""
_RECORD = "event_id, user_id, amount, ts_text, source, event_time, error_reason"
_WINDOW = """strftime(date_trunc('minute', event_time), '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(date_trunc('minute', event_time) + interval '1' minute, '%Y-%m-%d %H:%M:%S') AS window_end,
  count(*) AS valid_count, sum(amount) AS window_total_amount,
  sum(amount) / count(*) AS window_avg_amount"""
_METRICS = """metrics AS (
  SELECT batch_id, strftime(max(ingest_ts), '%Y-%m-%d %H:%M:%S') || ' UTC' AS batch_ts,
         cast(sum(CASE WHEN is_valid THEN 1 ELSE 0 END) AS bigint) AS batch_valid,
         cast(sum(CASE WHEN is_valid THEN 0 ELSE 1 END) AS bigint) AS batch_dlq,
         coalesce(sum(CASE WHEN is_valid THEN amount END), 0) AS batch_amount
  FROM cls GROUP BY batch_id)"""


def _txn(select: str) -> str:
    return f"WITH {TXN} {select}"


def _cls(select: str, *more: str) -> str:
    return f"WITH {', '.join([CLS, *more])} {select}"


def _rule(cases: str) -> str:
    return _txn(
        f"SELECT event_id, reason FROM (SELECT event_id, CASE {cases} END AS reason FROM timed) "
        "WHERE reason IS NOT NULL"
    )


def _encoded(valid: bool) -> str:
    null_key = "UNKNOWN" if valid else "INVALID"
    return _cls(
        f"SELECT event_id, coalesce(user_id, '{null_key}') AS key, user_id, amount, "
        f"ts_text AS timestamp, source, event_time, is_valid, error_reason "
        f"FROM cls WHERE {'is_valid' if valid else 'NOT is_valid'}"
    )


def _recent(valid: bool) -> str:
    return _cls(
        "SELECT event_id, user_id, amount, ts_text, source, error_reason AS reason FROM cls "
        f"WHERE {'is_valid' if valid else 'NOT is_valid'} ORDER BY event_id DESC LIMIT 50"
    )


def _feed(valid: bool) -> str:
    # Amounts of the fixture are whole numbers.
    shown = "'Rp ' || replace(format('{:,}', cast(amount AS bigint)), ',', '.')"
    if valid:
        fields = f"coalesce(nullif(user_id, ''), 'UNKNOWN') AS user_id, {shown} AS amount, " \
            "coalesce(nullif(ts_text, ''), 'N/A') AS ts_text, coalesce(nullif(source, ''), 'N/A') AS source"
    else:
        fields = f"coalesce(nullif(user_id, ''), 'NULL') AS user_id, " \
            f"CASE WHEN amount IS NULL THEN 'NULL' ELSE {shown} END AS amount, " \
            "coalesce(nullif(ts_text, ''), 'NULL') AS ts_text, " \
            "coalesce(nullif(source, ''), 'UNKNOWN') AS source, " \
            "coalesce(nullif(error_reason, ''), 'Validation Failed') AS error_reason"
    return _cls(
        f"SELECT event_id, {fields} FROM cls WHERE {'is_valid' if valid else 'NOT is_valid'} "
        "ORDER BY event_id DESC LIMIT 50"
    )


def _closed(until: str) -> str:
    """Windows that end no later than a time."""
    return _cls(
        f"SELECT {_WINDOW} FROM cls WHERE is_valid GROUP BY date_trunc('minute', event_time) "
        f"HAVING date_trunc('minute', event_time) + interval '1' minute <= {until}"
    )


_COUNTERS = _cls(
    "SELECT CASE WHEN is_valid THEN 'transactions_valid' ELSE 'transactions_dlq' END AS topic, "
    "count(*) AS n, coalesce(sum(amount), 0) AS amount FROM cls GROUP BY is_valid"
)
# A wave's keyed records count unless their event lies behind the watermark: the newest event of
# earlier waves less three minutes. Records without key or event time are never dropped.
_DEDUP = _txn(f"""
, edges AS (
  SELECT count(*) AS n, max(event_id) // {fixture.BATCH_ROWS} + 1 AS b FROM txn),
waves AS (
  SELECT user_id, ts_text, event_time,
         coalesce({" + ".join(
             f"cast(event_id >= b * {w} // {fixture.STREAM_WAVES} * {fixture.BATCH_ROWS} AS integer)"
             for w in range(1, fixture.STREAM_WAVES)
         )}, 0) AS wave,
         event_time IS NOT NULL AND user_id IS NOT NULL AND trim(user_id) <> '' AS keyed
  FROM timed, edges),
marks AS (
  SELECT w.wave, (SELECT max(event_time) FROM waves e WHERE e.keyed AND e.wave < w.wave) - interval '180' second AS mark
  FROM (SELECT DISTINCT wave FROM waves) w)
SELECT DISTINCT user_id, ts_text FROM waves JOIN marks USING (wave)
WHERE keyed AND (mark IS NULL OR event_time > mark)
UNION ALL SELECT user_id, ts_text FROM waves WHERE NOT keyed""")
_ERROR_REASON = _cls("SELECT event_id, is_valid, error_reason FROM cls")
_WINDOW_1M = _cls(f"SELECT {_WINDOW} FROM cls WHERE is_valid GROUP BY date_trunc('minute', event_time)")
_RUNNING = _cls(
    "SELECT batch_id, batch_ts AS timestamp, sum(batch_amount) OVER w AS running_total, "
    "batch_valid, batch_dlq, cast(sum(batch_valid) OVER w AS bigint) AS cum_valid_count, "
    "cast(sum(batch_dlq) OVER w AS bigint) AS cum_dlq_count FROM metrics "
    "WINDOW w AS (ORDER BY batch_id ROWS UNBOUNDED PRECEDING)",
    _METRICS,
)


def oracle_sql() -> dict[str, str]:
    return {
        "decode_json": _txn("SELECT event_id, user_id, amount, ts_text, source FROM txn"),
        "parse_event_time": _txn("SELECT event_id, event_time FROM timed"),
        "rule_mandatory": _rule(_MANDATORY),
        "rule_type": _rule(_TYPE),
        "rule_range": _rule(_RANGE),
        "rule_source": _rule(_SOURCE),
        "rule_lateness": _rule(_LATE),
        "dup_in_batch": _cls(
            "SELECT event_id, rn FROM cls WHERE user_id IS NOT NULL AND trim(user_id) <> '' "
            "AND ts_text IS NOT NULL AND trim(ts_text) <> ''"
        ),
        "dup_cross_batch": _cls(
            f"SELECT event_id FROM cls WHERE error_reason = '{rules.REPEAT_ACROSS}'"
        ),
        "error_reason": _ERROR_REASON,
        "reason_counts": _cls(
            "SELECT error_reason, count(*) AS n, sum(amount) AS amount FROM cls GROUP BY error_reason"
        ),
        "route_valid": _cls(f"SELECT {_RECORD} FROM cls WHERE is_valid"),
        "route_dlq": _cls(f"SELECT {_RECORD} FROM cls WHERE NOT is_valid"),
        "encode_valid": _encoded(True),
        "encode_dlq": _encoded(False),
        "topic_union": _cls(
            "SELECT 'transactions_valid' AS topic, event_id FROM cls WHERE is_valid "
            "UNION ALL SELECT 'transactions_dlq' AS topic, event_id FROM cls WHERE NOT is_valid"
        ),
        "topic_counters": _COUNTERS,
        "window_1m": _WINDOW_1M,
        "window_per_batch": _cls(
            f"SELECT batch_id, {_WINDOW} FROM cls WHERE is_valid "
            "GROUP BY batch_id, date_trunc('minute', event_time)"
        ),
        "batch_metrics": _cls("SELECT * FROM metrics", _METRICS),
        "running_totals": _RUNNING,
        "pass_rate": _cls(
            "SELECT valid, dlq, coalesce(round(valid * 100.0::double / nullif(valid + dlq, 0), 1), 100) AS rate "
            "FROM (SELECT cast(sum(CASE WHEN is_valid THEN 1 ELSE 0 END) AS bigint) AS valid, "
            "cast(sum(CASE WHEN is_valid THEN 0 ELSE 1 END) AS bigint) AS dlq FROM cls)"
        ),
        "recent_valid_50": _recent(True),
        "recent_dlq_50": _recent(False),
        "dedup_drop": _txn("SELECT DISTINCT user_id, ts_text FROM txn"),
        "decode_raw": f"WITH {_BEFORE_TIME} {_RAW} "
        f"SELECT event_id, raw, corrupt, user_id, {_PLAIN_AMOUNT}, ts_text, source FROM timed",
        "dead_letters_raw": f"WITH {_BEFORE_TIME} {_RAW}, {_JUDGED} SELECT event_id, "
        f"CASE WHEN CASE {_MANDATORY} {_TYPE} {_RANGE} {_SOURCE} {_LATE} END IS NOT NULL THEN raw END AS raw, "
        f"corrupt, user_id, {_PLAIN_AMOUNT}, ts_text, source, error_reason FROM cls WHERE NOT is_valid",
        "stream_dead_letters": f"WITH {_BEFORE_TIME} {_RAW}, {_JUDGED} SELECT event_id, raw, corrupt, error_reason "
        f"FROM cls WHERE CASE {_MANDATORY} {_TYPE} {_RANGE} {_SOURCE} {_LATE} END IS NOT NULL AND raw IS NOT NULL",
        "error_reason_skew": f"WITH {_BEFORE_TIME} {_SKEWED}, {_JUDGED} "
        "SELECT event_id, is_valid, error_reason FROM cls",
        "topic_readback": _cls(
            "SELECT CASE WHEN is_valid THEN 'transactions_valid' ELSE 'transactions_dlq' END AS topic, "
            f"CASE WHEN is_valid THEN 'valid' ELSE 'dlq' END AS side, is_valid, {_RECORD} FROM cls"
        ),
        "feed_valid_50": _feed(True),
        "feed_dlq_50": _feed(False),
        "stream_window_append": _closed("(SELECT max(ingest_ts) FROM cls) - interval '180' second"),
        "stream_window_final": _closed("(SELECT max(ingest_ts) FROM cls) - interval '180' second"),
        "stream_window_native": _closed(
            f"(SELECT max(event_time) FROM cls WHERE is_valid) - interval '{180 + fixture.SKEW}' second"
        ),
        "stream_readback": _COUNTERS,
        "stream_feed_50": _cls(
            "SELECT topic, event_id, user_id, amount, ts_text, source, error_reason FROM ("
            "SELECT *, CASE WHEN is_valid THEN 'transactions_valid' ELSE 'transactions_dlq' END AS topic, "
            "row_number() OVER (PARTITION BY is_valid ORDER BY event_id DESC) AS place FROM cls) WHERE place <= 50"
        ),
        "stream_dedup": _DEDUP,
        "stream_route": _ERROR_REASON,
        "stream_window": _WINDOW_1M,
        "stream_running_totals": _RUNNING,
    }
