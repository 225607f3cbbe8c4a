"""SQL equivalents of the registered queries, for an independent engine on the same tables."""

from __future__ import annotations

# ---- events ----------------------------------------------------------------------------------

EVENTS = """
base AS (
  SELECT event_id, ts, user_id, event_type, date_trunc('second', ts)::TIMESTAMP AS start,
         floor(value * 60)::BIGINT AS seconds,
         regexp_extract(props, '"k": *([0-9]+)', 1)::BIGINT AS k
  FROM events),
ev AS (
  SELECT event_id, 'trip_' || event_id AS trip_id,
    CASE WHEN event_id % 37 = 0 THEN 'abc' WHEN event_id % 31 = 0 THEN user_id || '.9'
         ELSE user_id::VARCHAR END AS bike_id,
    CASE WHEN event_id % 59 = 0 THEN NULL ELSE start END AS s,
    CASE WHEN event_id % 59 = 0 THEN 'x' ELSE 'ok' END AS s_text,
    NOT (event_id % 59 = 0) AND event_id % 47 = 0 AS s_naive,
    CASE WHEN event_id % 41 = 0 THEN start - INTERVAL 100 SECOND
         ELSE start + seconds * INTERVAL 1 SECOND END AS e,
    user_id % 50 AS start_station, k % 50 AS end_station,
    CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 71 = 0 THEN 'abc'
         ELSE (k + 5)::VARCHAR END AS age_text,
    CASE WHEN event_id % 61 = 0 THEN NULL WHEN event_id % 53 = 0 THEN 90000
         WHEN event_id % 43 = 0 THEN seconds + 3600 ELSE seconds END AS d,
    CASE event_type WHEN 'click' THEN 'electric' WHEN 'view' THEN 'classic'
         WHEN 'purchase' THEN 'docked' WHEN 'signup' THEN 'cargo' ELSE '' END AS bike_type,
    CASE WHEN event_id % 67 = 0 THEN 'guest' WHEN event_id % 3 = 0 THEN 'member'
         WHEN event_id % 3 = 1 THEN 'casual' END AS member,
    ts AS processed_at
  FROM base),
typed AS (
  SELECT *, CASE WHEN age_text IS NULL THEN 0 ELSE TRY_CAST(age_text AS BIGINT) END AS age,
    trunc(TRY_CAST(bike_id AS DOUBLE))::BIGINT AS bike,
    s IS NOT NULL AND NOT s_naive AS comparable,
    (epoch_us(e) - epoch_us(s)) / 1000000.0 AS gap
  FROM ev),
points AS (
  SELECT *,
    CASE WHEN bike IS NULL THEN 10 ELSE 0 END AS p1,
    CASE WHEN age IS NULL THEN 10 ELSE 0 END AS p4,
    CASE WHEN d IS NULL THEN 10 ELSE 0 END AS p5,
    CASE WHEN member = 'guest' THEN 5 ELSE 0 END AS p6,
    CASE WHEN comparable AND abs(gap - d) > 60 THEN 20 ELSE 0 END AS p8,
    CASE WHEN NOT comparable OR d IS NULL THEN 25 ELSE 0 END AS p9,
    CASE WHEN comparable AND e <= s THEN 30 ELSE 0 END AS p10,
    CASE WHEN d > 86400 THEN 15 ELSE 0 END AS p11,
    CASE WHEN age > 0 AND (age < 16 OR age > 100) THEN 10 ELSE 0 END AS p12,
    CASE WHEN start_station = end_station AND d < 300 THEN 5 ELSE 0 END AS p13,
    CASE WHEN bike_type NOT IN ('electric', 'classic', 'docked') THEN 25 ELSE 0 END AS p14
  FROM typed),
stream AS (
  SELECT *, greatest(0, 100 - p1 - p4 - p5 - p6 - p8 - p9 - p10 - p11 - p12 - p13 - p14) AS score,
    concat_ws(',',
      CASE WHEN p1 > 0 THEN 'invalid_bike_id' END,
      CASE WHEN p4 > 0 THEN 'invalid_rider_age' END,
      CASE WHEN p5 > 0 THEN 'invalid_trip_duration' END,
      CASE WHEN p6 > 0 THEN 'invalid_member_type' END,
      CASE WHEN p8 > 0 THEN 'duration_mismatch' END,
      CASE WHEN p9 > 0 THEN 'time_parsing_error' END,
      CASE WHEN p10 > 0 THEN 'invalid_time_sequence' END,
      CASE WHEN p11 > 0 THEN 'excessive_duration' END,
      CASE WHEN p12 > 0 THEN 'suspicious_age' END,
      CASE WHEN p13 > 0 THEN 'same_station_short_trip' END,
      CASE WHEN p14 > 0 THEN 'invalid_bike_type' END) AS issues
  FROM points),
meta AS (
  SELECT trip_id, bike, s, e, start_station, end_station, age, d, bike_type,
    coalesce(member, 'casual') AS member, score, issues, score >= 50 AS valid, processed_at
  FROM stream
  WHERE s IS NOT NULL AND d IS NOT NULL AND age IS NOT NULL AND bike IS NOT NULL),
last AS (SELECT max(ts) AS t FROM events)
"""

BATCH = EVENTS + """,
again AS (
  SELECT *, TRY_CAST(age_text AS DOUBLE) AS a,
    CASE WHEN d IS NULL THEN 1 ELSE 0 END AS no_d
  FROM typed),
judged AS (
  SELECT *,
    CASE WHEN bike_type = '' THEN 10 ELSE 0 END AS q1,
    CASE WHEN comparable AND s > e THEN 25 ELSE 0 END AS q2,
    CASE WHEN comparable AND abs(gap - d) > 60 THEN 15 ELSE 0 END AS q3,
    CASE WHEN NOT comparable OR no_d = 1 THEN 25 ELSE 0 END AS q4,
    CASE WHEN a < 16 OR a > 100 THEN 20 ELSE 0 END AS q5,
    CASE WHEN age_text = 'abc' THEN 10 ELSE 0 END AS q6,
    CASE WHEN d < 60 OR d > 86400 THEN 15 ELSE 0 END AS q7,
    CASE WHEN start_station = end_station AND d > 3600 THEN 5 ELSE 0 END AS q8,
    no_d * 15 AS q9
  FROM again),
batch AS (
  SELECT *, greatest(0, 100 - q1 - q2 - q3 - q4 - q5 - q6 - q7 - q8 - q9) AS bscore,
    concat_ws(',',
      CASE WHEN q1 > 0 THEN 'missing_bike_type' END,
      CASE WHEN q2 > 0 THEN 'invalid_time_sequence' END,
      CASE WHEN q3 > 0 THEN 'duration_mismatch' END,
      CASE WHEN q4 > 0 THEN 'time_parsing_error' END,
      CASE WHEN q5 > 0 THEN 'invalid_age' END,
      CASE WHEN q6 > 0 THEN 'invalid_age_format' END,
      CASE WHEN q7 > 0 THEN 'invalid_duration' END,
      CASE WHEN q8 > 0 THEN 'same_station_long_duration' END,
      CASE WHEN q9 > 0 THEN 'duration_calculation_error' END) AS bissues
  FROM judged)
"""


def half_up(total: str, count: str, digits: int) -> str:
    """Non-negative total / count rounded half up, in whole numbers."""
    scale = 10 ** digits
    return (f"(CAST(({2 * scale} * CAST({total} AS HUGEINT) + {count}) // (2 * {count}) AS DOUBLE)"
            f" / {scale})")


MEAN = "CAST(SUM(score) AS DOUBLE) / COUNT(*)"

QUALITY = {
    "quality_summary": f"""
      SELECT strftime(processed_at, '%Y-%m-%d') AS date, COUNT(*) AS total_trips,
        COUNT(*) FILTER (WHERE valid) AS valid_trips,
        COUNT(*) FILTER (WHERE NOT valid) AS invalid_trips,
        {half_up("SUM(score)", "COUNT(*)", 2)} AS avg_quality_score,
        {half_up("100 * COUNT(*) FILTER (WHERE valid)", "COUNT(*)", 2)} AS valid_percentage
      FROM meta GROUP BY 1""",
    "issue_frequency": f"""
      SELECT issue, COUNT(*) AS frequency,
        {half_up("100 * COUNT(*)", "(SELECT COUNT(*) FROM meta)", 2)} AS percentage
      FROM (SELECT unnest(string_split(issues, ',')) AS issue FROM meta WHERE issues <> '')
      GROUP BY issue""",
    "hourly_stats": f"""
      SELECT date_trunc('hour', processed_at)::TIMESTAMP AS hour, COUNT(*) AS trips_processed,
        {half_up("SUM(score)", "COUNT(*)", 2)} AS avg_quality,
        COUNT(*) FILTER (WHERE valid) AS valid_count,
        COUNT(*) FILTER (WHERE NOT valid) AS invalid_count
      FROM meta GROUP BY 1""",
    "overview": f"""
      SELECT COUNT(*) AS total_trips, {MEAN} AS avg_quality_score,
        COUNT(*) FILTER (WHERE valid) AS valid_trips,
        COUNT(*) FILTER (WHERE NOT valid) AS invalid_trips FROM meta""",
    "score_histogram": """
      SELECT (score // 10 * 10)::BIGINT AS score_bucket,
        (score // 10 * 10) || '-' || (score // 10 * 10 + 10) AS score_range, COUNT(*) AS trips
      FROM meta GROUP BY 1, 2""",
    "validity_split": """
      SELECT CASE WHEN valid THEN 'Valid' ELSE 'Invalid' END AS status, COUNT(*) AS trips
      FROM meta GROUP BY valid""",
    "trips_by_bike_type": "SELECT bike_type, COUNT(*) AS trips FROM meta GROUP BY 1",
    "trips_by_member":
        "SELECT member AS member_casual, COUNT(*) AS trips FROM meta GROUP BY 1",
    "recent_trips": """
      SELECT trip_id, bike_type, score::DOUBLE AS quality,
        CASE WHEN valid THEN 'Valid' ELSE 'Invalid' END AS status,
        strftime(m.processed_at, '%m/%d %H:%M:%S') AS processed_at
      FROM meta m ORDER BY m.processed_at DESC, trip_id LIMIT 10""",
    "recent_scores": """
      SELECT trip_id, score::DOUBLE AS quality_score, valid AS is_valid
      FROM meta ORDER BY processed_at DESC, trip_id LIMIT 5""",
    "validity_totals": f"""
      SELECT {MEAN} AS avg_score, SUM(CASE WHEN valid THEN 1 ELSE 0 END)::BIGINT AS valid_count,
        SUM(CASE WHEN NOT valid THEN 1 ELSE 0 END)::BIGINT AS invalid_count FROM meta""",
    "hourly_trend": f"""
      SELECT date_trunc('hour', processed_at)::TIMESTAMP AS hour, COUNT(*) AS trips,
        {MEAN} AS avg_quality
      FROM meta WHERE processed_at >= (SELECT t FROM last) - INTERVAL 24 HOUR GROUP BY 1""",
    "last_hour_quality": f"""
      SELECT coalesce({MEAN}, 0) AS avg_quality_score, COUNT(*) AS total_trips_last_hour,
        COUNT(*) FILTER (WHERE valid) AS valid_trips_last_hour
      FROM meta WHERE processed_at >= (SELECT t FROM last) - INTERVAL 1 HOUR""",
    "processed_on": """
      SELECT COUNT(*) AS trips FROM meta WHERE processed_at::DATE = DATE '2024-01-15'""",
    "reconcile": f"""
      SELECT sent, lost, {half_up("100 * lost", "sent", 2)} AS loss_percentage
      FROM (SELECT COUNT(DISTINCT trip_id) AS sent,
              COUNT(DISTINCT trip_id) FILTER (WHERE trip_id NOT IN (SELECT trip_id FROM meta))
              AS lost FROM ev)""",
    "batch_profile": """
      SELECT bike_type, COUNT(*) AS trips,
        strftime(min(processed_at), '%Y-%m-%dT%H:%M:%S.%fZ') AS min_ingested_at,
        strftime(max(processed_at), '%Y-%m-%dT%H:%M:%S.%fZ') AS max_ingested_at
      FROM ev GROUP BY 1""",
    "score_stream": """
      SELECT trip_id, score::BIGINT AS quality_score, issues AS quality_issues,
        score >= 50 AS is_valid FROM stream""",
    "metadata_eligible": """
      SELECT trip_id, bike AS bike_id, s AS start_time, e AS end_time,
        start_station AS start_station_id, end_station AS end_station_id, age AS rider_age,
        d AS trip_duration, bike_type, member AS member_casual, score::DOUBLE AS quality_score,
        valid AS is_valid FROM meta""",
    "quarantine": """
      SELECT trip_id, score::BIGINT AS quality_score, issues AS quality_issues
      FROM stream WHERE s IS NULL OR d IS NULL OR age IS NULL""",
    "ingest_stream": """
      SELECT trip_id, bike AS bike_id, s AS start_time, e AS end_time, age AS rider_age,
        d AS trip_duration, member AS member_casual, score::DOUBLE AS quality_score,
        issues AS quality_issues, valid AS is_valid, processed_at AS ingested_at FROM meta""",
    "hourly_stream": f"""
      SELECT date_trunc('hour', processed_at)::TIMESTAMP AS hour, COUNT(*) AS trips_processed,
        {half_up("SUM(score)", "COUNT(*)", 2)} AS avg_quality,
        COUNT(*) FILTER (WHERE score >= 50) AS valid_count,
        COUNT(*) FILTER (WHERE score < 50) AS invalid_count
      FROM stream GROUP BY 1""",
    "daily_stream": f"""
      SELECT date_trunc('day', processed_at)::TIMESTAMP AS date, COUNT(*) AS trips_processed,
        {half_up("SUM(score)", "COUNT(*)", 2)} AS avg_quality,
        COUNT(*) FILTER (WHERE score >= 50) AS valid_count,
        COUNT(*) FILTER (WHERE score < 50) AS invalid_count
      FROM stream GROUP BY 1""",
    "score_stream_damaged": """
      , damaged AS (
        SELECT trip_id, p10, p14,
          event_id % 19 = 0 AS x, event_id % 13 = 0 AS a, event_id % 17 = 0 AS b, p1, p4, p5, p6, p8, p9, p11, p12, p13,
          d, start_station, end_station FROM points),
      kept AS (
        SELECT trip_id, p10, p14, CASE WHEN x THEN 20 ELSE 0 END AS p7, p8, p9, p11, p12,
          CASE WHEN a AND NOT x THEN 10 ELSE 0 END AS p2, CASE WHEN b AND NOT x THEN 10 ELSE 0 END AS p3,
          CASE WHEN d < 300 AND (a AND b OR NOT a AND NOT b AND start_station = end_station)
            THEN 5 ELSE 0 END AS p13,
          CASE WHEN x THEN 0 ELSE p1 END AS p1, CASE WHEN x THEN 0 ELSE p4 END AS p4,
          CASE WHEN x THEN 0 ELSE p5 END AS p5, CASE WHEN x THEN 0 ELSE p6 END AS p6
        FROM damaged),
      total AS (
        SELECT *, greatest(0, 100 - p1 - p2 - p3 - p4 - p5 - p6 - p7 - p8 - p9 - p10 - p11 - p12 - p13 - p14)
          AS points_left FROM kept)
      SELECT trip_id, points_left::BIGINT AS quality_score, points_left >= 50 AS is_valid, concat_ws(',',
          CASE WHEN p1 > 0 THEN 'invalid_bike_id' END, CASE WHEN p2 > 0 THEN 'invalid_start_station' END,
          CASE WHEN p3 > 0 THEN 'invalid_end_station' END, CASE WHEN p4 > 0 THEN 'invalid_rider_age' END,
          CASE WHEN p5 > 0 THEN 'invalid_trip_duration' END, CASE WHEN p6 > 0 THEN 'invalid_member_type' END,
          CASE WHEN p7 > 0 THEN 'type_conversion_error' END, CASE WHEN p8 > 0 THEN 'duration_mismatch' END,
          CASE WHEN p9 > 0 THEN 'time_parsing_error' END, CASE WHEN p10 > 0 THEN 'invalid_time_sequence' END,
          CASE WHEN p11 > 0 THEN 'excessive_duration' END, CASE WHEN p12 > 0 THEN 'suspicious_age' END,
          CASE WHEN p13 > 0 THEN 'same_station_short_trip' END, CASE WHEN p14 > 0 THEN 'invalid_bike_type' END)
          AS quality_issues FROM total""",
    "bronze_rows": """
      SELECT trip_id, score::BIGINT AS quality_score, issues AS quality_issues,
        score >= 50 AS is_valid FROM stream
      WHERE bike_type <> 'classic' AND s IS NOT NULL AND d IS NOT NULL AND age IS NOT NULL""",
    "bronze_packed_rows": """
      SELECT trip_id, score::BIGINT AS quality_score, issues AS quality_issues, score >= 50 AS is_valid
      FROM stream WHERE s IS NOT NULL AND d IS NOT NULL AND age IS NOT NULL""",
    "bronze_since_bounds": """
      SELECT trip_id, score::BIGINT AS quality_score, issues AS quality_issues, score >= 50 AS is_valid
      FROM stream WHERE s IS NOT NULL AND d IS NOT NULL AND age IS NOT NULL AND member = 'member'""",
    "rejected_rows": "SELECT trip_id FROM stream WHERE bike_type = 'classic'",
    "upsert_metadata": """
      , keyed AS (
        SELECT *, 'u' || bike || 'd' || strftime(processed_at, '%Y%m%d') AS id FROM meta),
      firsts AS (
        SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY id ORDER BY processed_at) = 1),
      lasts AS (
        SELECT * FROM keyed
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY processed_at DESC) = 1)
      SELECT f.id AS trip_id, f.bike AS bike_id, f.s AS start_time, f.d AS trip_duration,
        f.bike_type, f.member AS member_casual, f.valid AS is_valid,
        l.score::DOUBLE AS quality_score, l.issues AS quality_issues, l.processed_at
      FROM firsts f JOIN lasts l ON f.id = l.id""",
}

BANDS = """CASE WHEN bscore >= 90 THEN 'EXCELLENT' WHEN bscore >= 75 THEN 'GOOD'
  WHEN bscore >= 60 THEN 'FAIR' ELSE 'POOR' END"""

JUDGED = {
    "score_batch_missing": """
      , lost AS (
        SELECT *, event_id % 13 = 0 AS m2, event_id % 17 = 0 AS m3, event_id % 19 = 0 AS m4,
          event_id % 23 = 0 AS m5, event_id % 11 = 0 AS m6, event_id % 7 = 0 AS m7 FROM judged),
      found AS (
        SELECT *, m3 OR m4 AS no_times,
          NOT m3 AND s IS NULL OR (NOT m3 AND NOT m4 AND s IS NOT NULL AND s_naive) AS bad_times FROM lost),
      again2 AS (
        SELECT *,
          CASE WHEN NOT no_times THEN q2 ELSE 0 END AS r2,
          CASE WHEN NOT no_times AND NOT m7 THEN q3 ELSE 0 END AS r3,
          CASE WHEN bad_times OR (no_d = 1 AND NOT m7) THEN 25 ELSE 0 END AS r4,
          CASE WHEN NOT m7 THEN q7 ELSE 0 END AS r7,
          CASE WHEN NOT m7 AND d > 3600 AND (m5 AND m6 OR NOT m5 AND NOT m6 AND start_station = end_station)
            THEN 5 ELSE 0 END AS r8,
          CASE WHEN NOT m7 THEN q9 ELSE 0 END AS r9
        FROM found),
      total AS (
        SELECT *, greatest(0, 100 - 10 * (m2::INT + m3::INT + m4::INT + m5::INT + m6::INT + m7::INT)
          - q1 - r2 - r3 - r4 - q5 - q6 - r7 - r8 - r9) AS rscore FROM again2)
      SELECT trip_id, rscore::BIGINT AS quality_score, rscore >= 60 AS is_valid_quality,
        concat_ws(',', CASE WHEN m2 THEN 'missing_bike_id' END, CASE WHEN m3 THEN 'missing_start_time' END,
          CASE WHEN m4 THEN 'missing_end_time' END, CASE WHEN m5 THEN 'missing_start_station_id' END,
          CASE WHEN m6 THEN 'missing_end_station_id' END, CASE WHEN m7 THEN 'missing_trip_duration' END,
          CASE WHEN q1 > 0 THEN 'missing_bike_type' END, CASE WHEN r2 > 0 THEN 'invalid_time_sequence' END,
          CASE WHEN r3 > 0 THEN 'duration_mismatch' END, CASE WHEN r4 > 0 THEN 'time_parsing_error' END,
          CASE WHEN q5 > 0 THEN 'invalid_age' END, CASE WHEN q6 > 0 THEN 'invalid_age_format' END,
          CASE WHEN r7 > 0 THEN 'invalid_duration' END, CASE WHEN r8 > 0 THEN 'same_station_long_duration' END,
          CASE WHEN r9 > 0 THEN 'duration_calculation_error' END) AS quality_issues FROM total""",
    "silver_rows": """
      SELECT trip_id, bscore::BIGINT AS quality_score, bissues AS quality_issues FROM batch
      WHERE bscore >= 60""",
    "quality_report_rows": f"""
      SELECT COUNT(*) FILTER (WHERE {BANDS} = 'EXCELLENT') AS "EXCELLENT",
        COUNT(*) FILTER (WHERE {BANDS} = 'GOOD') AS "GOOD",
        COUNT(*) FILTER (WHERE {BANDS} = 'FAIR') AS "FAIR",
        COUNT(*) FILTER (WHERE {BANDS} = 'POOR') AS "POOR",
        COUNT(*) AS total_records, COUNT(*) FILTER (WHERE bscore >= 60) AS valid_records,
        COUNT(*) FILTER (WHERE bscore < 60) AS invalid_records,
        '2024-02-01' AS date, '10' AS hour FROM batch""",
    "issues_json": """
      SELECT trip_id, CASE WHEN coalesce(bissues, '') = '' THEN '[]'
        ELSE to_json(string_split(bissues, ','))::VARCHAR END AS issues FROM batch""",
    "score_batch": """
      SELECT trip_id, bscore::BIGINT AS quality_score, bissues AS quality_issues,
        bscore >= 60 AS is_valid_quality FROM batch""",
    "quality_bands": f"SELECT {BANDS} AS quality_band, COUNT(*) AS trips FROM batch GROUP BY 1",
    "batch_quality_stats": f"""
      SELECT COUNT(*) FILTER (WHERE {BANDS} = 'EXCELLENT') AS "EXCELLENT",
        COUNT(*) FILTER (WHERE {BANDS} = 'GOOD') AS "GOOD",
        COUNT(*) FILTER (WHERE {BANDS} = 'FAIR') AS "FAIR",
        COUNT(*) FILTER (WHERE {BANDS} = 'POOR') AS "POOR",
        COUNT(*) AS total_records,
        COUNT(*) FILTER (WHERE bscore >= 60) AS valid_records,
        COUNT(*) FILTER (WHERE bscore < 60) AS invalid_records,
        CAST(SUM(bscore) AS DOUBLE) / COUNT(*) AS avg_score,
        (SELECT t FROM last) AS timestamp
      FROM batch""",
}

CHECKS = EVENTS + f""",
totals AS (
  SELECT CASE event_type WHEN 'click' THEN 'api' WHEN 'view' THEN 's3'
      WHEN 'purchase' THEN 'postgresql' WHEN 'signup' THEN 'sqs' ELSE 'worker' END AS service,
    COUNT(*) AS n, SUM(floor(value)::BIGINT) AS units
  FROM events GROUP BY 1),
checks AS (
  SELECT service, n,
    CASE WHEN service <> 'sqs' AND units % 2 = 0 THEN 'unhealthy' ELSE 'healthy' END AS status,
    CASE WHEN units % 2 = 0 THEN 'units ' || units END AS error
  FROM totals),
system AS (
  SELECT CASE WHEN bool_and(status = 'healthy') THEN 'healthy' ELSE 'degraded' END AS system_status,
    coalesce(string_agg(service, ',' ORDER BY service) FILTER (WHERE status <> 'healthy'), '')
      AS degraded_services,
    max(CASE WHEN service = 'api' THEN status END) AS api_status,
    max(CASE WHEN service = 'api' THEN error END) AS api_error,
    max(CASE WHEN service = 'sqs' AND status = 'healthy' THEN n END) AS message_count,
    max(CASE WHEN service = 'postgresql' AND status = 'healthy' THEN n END) AS total_trips,
    COUNT(*) FILTER (WHERE status <> 'healthy') AS down
  FROM checks),
quality AS (
  SELECT coalesce({MEAN}, 0) AS avg_quality_score, COUNT(*) AS total_trips_last_hour,
    COUNT(*) FILTER (WHERE valid) AS valid_trips_last_hour
  FROM meta WHERE processed_at >= (SELECT t FROM last) - INTERVAL 1 HOUR),
metrics AS (SELECT * FROM system, quality),
fired AS (
  SELECT 'system_degraded' AS type, 'high' AS severity, down::DOUBLE AS value
    FROM metrics WHERE system_status <> 'healthy'
  UNION ALL SELECT 'api_down', 'high', NULL FROM metrics WHERE api_status <> 'healthy'
  UNION ALL SELECT 'low_data_quality', 'medium', avg_quality_score
    FROM metrics WHERE avg_quality_score < 70
  UNION ALL SELECT 'high_invalid_data', 'medium',
      valid_trips_last_hour::DOUBLE / total_trips_last_hour FROM metrics
    WHERE total_trips_last_hour > 0
      AND valid_trips_last_hour::DOUBLE / total_trips_last_hour < 0.8
  UNION ALL SELECT 'sqs_backlog', 'medium', message_count::DOUBLE
    FROM metrics WHERE message_count > 1000)
"""

MONITORING = {
    "alerts_all": """
      SELECT type, severity, value FROM fired WHERE type IN ('system_degraded', 'sqs_backlog')
      UNION ALL SELECT 'api_down', 'high', NULL
      UNION ALL SELECT 'low_data_quality', 'medium', avg_quality_score / 2 FROM metrics WHERE avg_quality_score / 2 < 70
      UNION ALL SELECT 'high_invalid_data', 'medium', (total_trips_last_hour // 2)::DOUBLE / total_trips_last_hour
        FROM metrics WHERE total_trips_last_hour > 0""",
    "monitoring_rows": """
      SELECT '2024-02-01' AS date, '10' AS hour, '1007' AS minute, total_trips_last_hour,
        (SELECT nullif(COUNT(*), 0) FROM fired) AS alert_count FROM metrics""",
    "system_status": "SELECT system_status, degraded_services FROM system",
    "observability_metrics": """
      SELECT (SELECT t FROM last) AS timestamp, system_status, degraded_services, api_status,
        true AS api_checked, api_error, message_count, total_trips, avg_quality_score,
        total_trips_last_hour, valid_trips_last_hour FROM metrics""",
    "alerts": "SELECT type, severity, value FROM fired",
    "alert_summary": """
      SELECT COUNT(*) FILTER (WHERE severity = 'high') AS high_alerts,
        COUNT(*) FILTER (WHERE severity = 'medium') AS medium_alerts,
        COUNT(*) AS alert_count FROM fired""",
}

# ---- trips -----------------------------------------------------------------------------------

LINES = """
lines AS (
  SELECT *, l_shipdate + ((l_partkey * 7919 + l_suppkey * 104729 + l_orderkey * 31) % 86400)
      * INTERVAL 1 SECOND AS started,
    l_quantity::BIGINT * l_linenumber * 60 + l_partkey % 60 AS seconds,
    l_partkey % 331 AS to_station
  FROM lineitem)
"""

TRIPS = LINES + """,
trips AS (
  SELECT l_orderkey || '-' || l_linenumber AS ride_id, started AS started_at,
    started + seconds * INTERVAL 1 SECOND AS ended_at,
    l_suppkey::VARCHAR AS start_station_id,
    CASE WHEN l_suppkey % 7 <> 0 THEN 'Station ' || l_suppkey ||
      CASE WHEN l_linenumber > 4 THEN ' (new)' ELSE '' END END AS start_station_name,
    CASE WHEN l_suppkey % 11 <> 0 THEN 40.0::DOUBLE + l_suppkey / 1000.0::DOUBLE END AS start_lat,
    CASE WHEN l_suppkey % 11 <> 0 THEN -74.0::DOUBLE + l_suppkey / 1000.0::DOUBLE END AS start_lng,
    to_station::VARCHAR AS end_station_id,
    CASE WHEN to_station % 7 <> 0 THEN 'Station ' || to_station ||
      CASE WHEN l_linenumber > 4 THEN ' (new)' ELSE '' END END AS end_station_name,
    CASE WHEN to_station % 11 <> 0 THEN 40.0::DOUBLE + to_station / 1000.0::DOUBLE END AS end_lat,
    CASE WHEN to_station % 11 <> 0 THEN -74.0::DOUBLE + to_station / 1000.0::DOUBLE END AS end_lng,
    CASE l_returnflag WHEN 'R' THEN 'member' WHEN 'A' THEN 'casual' END AS member_casual,
    seconds AS tripduration_seconds,
    CASE WHEN l_discount > 0 THEN (l_orderkey % 5000)::VARCHAR END AS bikeid,
    CASE WHEN l_linenumber = 7 THEN NULL WHEN l_tax = 0 THEN 0
      ELSE 1940 + l_partkey % 70 END AS birth_year,
    strftime(l_shipdate, '%Y%m') || '-trips.csv' AS source_file,
    l_orderkey * 8 + l_linenumber AS position
  FROM lines)
"""


def _top(label: str, name: str, n: int, where: str = "") -> str:
    return (f"SELECT {label} AS {name}, COUNT(*) AS trips FROM trips {where} GROUP BY 1 "
            f"ORDER BY trips DESC, {name} NULLS FIRST LIMIT {n}")


AVERAGE = half_up("SUM(tripduration_seconds)", "COUNT(*)", 1)

STATIONS_OF = """
  SELECT station_id, station_name, latitude, longitude FROM (
    SELECT 0 AS role, start_station_id AS station_id, start_station_name AS station_name,
      start_lat AS latitude, start_lng AS longitude, position, started_at FROM trips
    UNION ALL
    SELECT 1, end_station_id, end_station_name, end_lat, end_lng, position, started_at FROM trips)
  {where}
  QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY role, position) = 1
"""

USAGE = {
    "stored_ride_ids": """
      SELECT strftime(started_at, '%Y-%m') AS year_month, COUNT(DISTINCT ride_id) AS rides
      FROM trips WHERE position % 9 IN (0, 3) GROUP BY 1""",
    "trip_range": """
      SELECT MIN(started_at) AS min_started_at, MAX(started_at) AS max_started_at,
        COUNT(*) AS n_rows FROM trips""",
    "trip_kpis": f"""
      SELECT COUNT(*) AS trips, {AVERAGE} AS avg_secs,
        quantile_cont(tripduration_seconds, 0.5)::DOUBLE AS p50_secs,
        COUNT(DISTINCT start_station_id) AS start_stations,
        COUNT(DISTINCT end_station_id) AS end_stations FROM trips""",
    "trips_per_day": """
      SELECT strftime(started_at, '%Y-%m-%d') AS day, COUNT(*) AS trips FROM trips GROUP BY 1""",
    "trip_filter": """
      SELECT strftime(started_at, '%Y-%m-%d') AS day, COUNT(*) AS trips FROM trips
      WHERE started_at >= DATE '1997-03-01' AND started_at < DATE '1998-02-28' + INTERVAL 1 DAY
        AND coalesce(member_casual, '') IN ('member', 'casual') GROUP BY 1""",
    "top_start_stations": _top("coalesce(start_station_name, start_station_id)", "station", 20),
    "top_end_stations": _top("coalesce(end_station_name, end_station_id)", "station", 20),
    "duration_by_member": f"""
      SELECT coalesce(member_casual, '(desconocido)') AS member_casual, {AVERAGE} AS avg_secs,
        quantile_cont(tripduration_seconds, 0.5)::DOUBLE AS p50_secs, COUNT(*) AS trips
      FROM trips GROUP BY 1""",
    "top_bikes": _top("bikeid", "bikeid", 10),
    "trips_per_hour":
        "SELECT hour(started_at)::BIGINT AS hour, COUNT(*) AS trips FROM trips GROUP BY 1",
    "trips_per_weekday":
        "SELECT dayname(started_at) AS weekday, COUNT(*) AS trips FROM trips GROUP BY 1",
    "top_birth_years":
        _top("birth_year::BIGINT", "birth_year", 20, "WHERE birth_year IS NOT NULL"),
    "longest_trips": """
      SELECT ride_id, started_at, ended_at, tripduration_seconds FROM trips
      WHERE tripduration_seconds > 7200
      ORDER BY tripduration_seconds DESC, ride_id, started_at, ended_at LIMIT 20""",
    "map_sample": """
      SELECT start_lat AS lat, start_lng AS lon FROM trips
      WHERE start_lat IS NOT NULL AND start_lng IS NOT NULL
      ORDER BY ride_id, started_at, start_lat, start_lng LIMIT 5000""",
    "ride_keys": """
      SELECT ride_id AS original_id, md5(source_file || '|' ||
        strftime(started_at, '%Y-%m-%d %H:%M:%S') || '|' ||
        strftime(ended_at, '%Y-%m-%d %H:%M:%S') || '|' || coalesce(bikeid, '')) AS ride_key
      FROM trips""",
    "insert_if_absent": """
      SELECT ride_id, started_at, tripduration_seconds, start_station_id, end_station_id
      FROM trips WHERE started_at >= TIMESTAMP '1998-01-01'
      QUALIFY row_number() OVER (PARTITION BY ride_id, started_at ORDER BY tripduration_seconds,
        start_station_id, end_station_id, bikeid NULLS FIRST) = 1""",
    "build_stations": f"""
      SELECT *, TIMESTAMP '2001-01-01' AS first_seen, TIMESTAMP '2001-01-01' AS last_seen
      FROM ({STATIONS_OF.format(where="")})""",
    "upsert_stations": f"""
      SELECT coalesce(o.station_id, n.station_id) AS station_id,
        coalesce(n.station_name, o.station_name) AS station_name,
        coalesce(n.latitude, o.latitude) AS latitude,
        coalesce(n.longitude, o.longitude) AS longitude,
        CASE WHEN o.station_id IS NOT NULL THEN TIMESTAMP '1998-01-01'
          ELSE TIMESTAMP '2001-01-01' END AS first_seen,
        CASE WHEN n.station_id IS NOT NULL THEN TIMESTAMP '2001-01-01'
          ELSE TIMESTAMP '1998-01-01' END AS last_seen
      FROM ({STATIONS_OF.format(where="WHERE started_at < TIMESTAMP '1998-01-01'")}) o
      FULL JOIN ({STATIONS_OF.format(where="WHERE started_at >= TIMESTAMP '1998-01-01'")}) n
        ON o.station_id = n.station_id""",
    "upsert_ledger": """
      SELECT source_file, COUNT(*) AS records_loaded, TIMESTAMP '2001-01-01' AS load_date
      FROM trips WHERE started_at >= TIMESTAMP '1998-01-01' GROUP BY 1
      UNION ALL
      SELECT source_file, COUNT(*), TIMESTAMP '1999-01-01'
      FROM trips WHERE started_at < TIMESTAMP '1999-01-01'
        AND source_file NOT IN
          (SELECT source_file FROM trips WHERE started_at >= TIMESTAMP '1998-01-01') GROUP BY 1""",
    "schema_check": """
      SELECT 'missing' AS kind, unnest(['rideable_type', 'usertype', 'gender', 'load_timestamp',
        'year_month']) AS item
      UNION ALL SELECT 'extra', 'position'
      UNION ALL SELECT 'duplicate_key', 'ride_id,started_at: ' || COUNT(*)
      FROM (SELECT ride_id FROM trips GROUP BY ride_id, started_at HAVING COUNT(*) > 1)
      HAVING COUNT(*) > 0""",
    "files_to_load": """
      SELECT DISTINCT source_file FROM trips WHERE source_file NOT IN
        (SELECT source_file FROM trips WHERE started_at < TIMESTAMP '1998-01-01')""",
}

CLEAN = LINES + """,
parsed AS (
  SELECT *, year(l_shipdate) >= 2000 AS modern,
    CASE WHEN l_orderkey % 97 <> 0 THEN started END AS s,
    started + seconds * INTERVAL 1 SECOND AS e,
    CASE WHEN l_discount = 0 OR (l_tax = 0.07 AND l_linenumber = 5
           AND NOT (l_tax = 0 AND l_linenumber = 7)) THEN NULL
         WHEN l_tax = 0 AND l_linenumber = 7 THEN 0
         WHEN l_tax = 0.08 AND l_linenumber = 6 THEN 90000
         ELSE seconds END::DOUBLE AS given,
    1940 + l_partkey % 90 AS born
  FROM lines),
clean AS (
  SELECT
    CASE WHEN modern AND l_suppkey % 50 <> 0 THEN l_orderkey || '-' || l_linenumber END AS ride_id,
    CASE WHEN modern THEN 'electric_bike' ELSE 'classic_bike' END AS rideable_type,
    s AS started_at, e AS ended_at,
    CASE WHEN l_linenumber = 4 THEN ' ' ELSE '' END || l_suppkey AS start_station_id,
    CASE WHEN l_suppkey % 7 <> 0 THEN 'Station ' || l_suppkey END AS start_station_name,
    40.0::DOUBLE + l_suppkey / 1000.0::DOUBLE AS start_lat,
    CASE WHEN l_suppkey % 11 <> 0 THEN -74.0::DOUBLE + l_suppkey / 1000.0::DOUBLE END AS start_lng,
    to_station::VARCHAR AS end_station_id, 'Station ' || to_station AS end_station_name,
    40.0::DOUBLE + to_station / 1000.0::DOUBLE AS end_lat,
    -74.0::DOUBLE + to_station / 1000.0::DOUBLE AS end_lng,
    CASE WHEN modern AND l_returnflag = 'R' THEN 'member'
         WHEN modern AND l_returnflag = 'A' THEN 'casual'
         WHEN l_returnflag = 'N' THEN NULL
         WHEN l_linestatus = 'F' THEN 'member' ELSE 'casual' END AS member_casual,
    coalesce(given, seconds::DOUBLE) AS tripduration_seconds,
    CASE WHEN l_discount <> 0.1 THEN (l_orderkey % 5000)::VARCHAR END AS bikeid,
    CASE WHEN l_returnflag = 'N' THEN 'Dependent' WHEN l_linestatus = 'F' THEN 'Subscriber'
         ELSE 'Customer' END AS usertype,
    CASE WHEN l_tax = 0 OR l_linenumber = 1 OR born > 2026 THEN NULL ELSE born END::DOUBLE
      AS birth_year,
    CASE WHEN l_linenumber % 4 <> 3 THEN l_linenumber % 4 END::DOUBLE AS gender,
    strftime(l_shipdate, '%Y%m') || '-trips.csv' AS source_file,
    l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate
  FROM parsed
  WHERE s IS NOT NULL AND coalesce(given, seconds::DOUBLE) > 0
    AND coalesce(given, seconds::DOUBLE) <= 86400)
"""

CLEAN_COLUMNS = """ride_id, rideable_type, started_at, ended_at, start_station_id,
  start_station_name, start_lat, start_lng, end_station_id, end_station_name, end_lat, end_lng,
  member_casual, tripduration_seconds, bikeid, usertype, birth_year, gender, source_file"""

CLEANING = {
    "raw_csv_rows": """
      SELECT source_file, COUNT(*) AS trips, SUM(tripduration_seconds)::BIGINT AS seconds,
        COUNT(*) FILTER (WHERE l_suppkey = 5 AND l_linenumber <> 4) AS broken_names, NULL::VARCHAR AS error
      FROM clean WHERE substr(source_file, 5, 2) NOT IN ('07', '11') GROUP BY 1
      UNION ALL SELECT DISTINCT strftime(l_shipdate, '%Y%m') || '-trips.csv', NULL::BIGINT, NULL::BIGINT, NULL::BIGINT,
        CASE month(l_shipdate) WHEN 7 THEN 'a row of 19 fields under 18 columns' ELSE 'a quote without end' END
      FROM lines WHERE month(l_shipdate) IN (7, 11)""",
    "read_clean_rows": """
      SELECT source_file, COUNT(*) AS n, min(started_at) AS first, max(ended_at) AS last FROM clean GROUP BY 1""",
    "load_trips_run": """
      , keys AS (SELECT DISTINCT source_file, strftime(started_at, '%Y-%m-%d %H:%M:%S') AS s,
          strftime(ended_at, '%Y-%m-%d %H:%M:%S') AS e, coalesce(bikeid, '') AS b,
          strftime(started_at, '%Y-%m') AS year_month FROM clean)
      SELECT year_month, COUNT(*) AS trips, COUNT(*) AS rides FROM keys GROUP BY 1""",
    "ledger_run": """
      SELECT source_file, COUNT(*) AS records_loaded, TIMESTAMP '2026-01-01' AS load_date
      FROM clean GROUP BY 1""",
    "clean_trips": f"SELECT {CLEAN_COLUMNS} FROM clean",
    "dedupe_rides": f"""
      , files AS (SELECT source_file AS f, bool_or(ride_id IS NOT NULL) AS ids FROM clean GROUP BY 1)
      SELECT {CLEAN_COLUMNS} FROM clean JOIN files ON source_file = f
      QUALIFY row_number() OVER (
        PARTITION BY source_file, ride_id, CASE WHEN NOT ids THEN started_at END,
          CASE WHEN NOT ids THEN ended_at END, CASE WHEN NOT ids THEN bikeid END,
          CASE WHEN NOT ids THEN start_station_id END, CASE WHEN NOT ids THEN end_station_id END
        ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) = 1""",
    "warehouse_trips": """
      SELECT md5('/clean/' || source_file || '|' ||
          strftime(started_at, '%Y-%m-%d %H:%M:%S') || '|' ||
          strftime(ended_at, '%Y-%m-%d %H:%M:%S') || '|' || coalesce(bikeid, '')) AS ride_id,
        rideable_type, started_at, ended_at, start_station_id, start_station_name,
        start_lat::FLOAT::DOUBLE AS start_lat, coalesce(start_lng, 0)::FLOAT::DOUBLE AS start_lng,
        end_station_id, end_station_name, end_lat::FLOAT::DOUBLE AS end_lat,
        end_lng::FLOAT::DOUBLE AS end_lng, coalesce(member_casual, 'unknown') AS member_casual,
        tripduration_seconds::BIGINT AS tripduration_seconds, bikeid, usertype,
        coalesce(birth_year, 0)::BIGINT AS birth_year, coalesce(gender, 0)::BIGINT AS gender,
        '/clean/' || source_file AS source_file, strftime(started_at, '%Y-%m') AS year_month
      FROM clean""",
}

# ---- file listings ---------------------------------------------------------------------------

LISTING = """
manifest AS (
  SELECT *, CASE WHEN o_custkey % 20 = 0 THEN 'jc-' WHEN o_custkey % 10 = 0 THEN 'JC-' ELSE '' END
      || strftime(o_orderdate, '%Y%m') || '-' || o_orderkey || '-tripdata'
      || CASE o_orderstatus WHEN 'F' THEN '.csv.zip' WHEN 'O' THEN '.ZIP' ELSE '.html' END AS name,
    CASE WHEN o_orderpriority <> '5-LOW' THEN floor(o_totalprice)::BIGINT END AS size
  FROM orders)
"""

LISTINGS = {
    "select_archives": """
      SELECT 'data/' || name AS key, size FROM manifest
      WHERE lower(name) LIKE '%.zip' AND NOT upper(name) LIKE 'JC-%'
        AND regexp_matches(name, '^199[5-8]')""",
    "archives_to_fetch": """
      SELECT 'data/' || name AS key FROM manifest
      WHERE NOT (o_orderpriority = '5-LOW'
        OR (o_orderpriority = '1-URGENT' AND o_custkey % 2 = 0))""",
    "transfer_summary": """
      SELECT CASE o_orderstatus WHEN 'F' THEN 'ok' WHEN 'O' THEN 'skipped' ELSE 'failed' END
        AS outcome, COUNT(*) AS files FROM orders GROUP BY 1""",
    "entries_to_extract": """
      SELECT strftime(o_orderdate, '%Y%m') AS archive,
        'in/' || o_orderkey || '/' || CASE WHEN o_orderstatus = 'P' THEN '._' ELSE '' END ||
          'Trips_' || o_custkey || '.csv' AS entry,
        CASE WHEN o_orderstatus = 'P' THEN '._' ELSE '' END || 'Trips_' || o_custkey || '.csv'
          AS name
      FROM orders
      WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE floor(c_acctbal) > 0)
      QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY archive, entry) = 1""",
    "files_to_clean": """
      SELECT DISTINCT '/raw/' || strftime(o_orderdate, '%Y%m') || '-trips.csv' AS path FROM orders
      WHERE strftime(o_orderdate, '%Y%m') NOT IN
        (SELECT strftime(o_orderdate, '%Y%m') FROM orders
         WHERE o_orderdate < TIMESTAMP '1998-01-01')""",
    "latest_month_archive": """
      SELECT month || '-citibike-tripdata.csv.zip' AS filename,
        'historical/' || month || '-citibike-tripdata.csv.zip' AS bronze_key,
        CASE WHEN month IN (SELECT strftime(o_orderdate, '%Y%m') FROM orders
          WHERE o_orderstatus = 'F') THEN 'exists' ELSE 'new' END AS status
      FROM (SELECT CASE WHEN bool_or(strftime(o_orderdate, '%Y%m') = '200109') THEN '200109'
        ELSE '200108' END AS month FROM orders)""",
}


PLAIN = {
    "extract_run": """
      SELECT o_orderkey AS order_key,
        o_custkey::VARCHAR || CASE WHEN o_orderkey % 5 = 0 THEN chr(10) || o_orderpriority ELSE '' END AS station,
        o_orderstatus AS usertype, strftime(o_orderdate, '%Y%m') AS month FROM orders""",
    "union_all": """
      SELECT c_name AS name, c_nationkey::BIGINT AS nation FROM customer
      UNION ALL SELECT p_name, NULL FROM part""",
}


def sql() -> dict[str, str]:
    groups = [
        (EVENTS, QUALITY), (BATCH, JUDGED), (CHECKS, MONITORING), (TRIPS, USAGE),
        (CLEAN, CLEANING), (LISTING, LISTINGS),
    ]
    found = {
        name: f"WITH {prefix.strip()} {text.strip()}"
        for prefix, queries in groups for name, text in queries.items()
    }
    same = {"metadata_after_fold": "upsert_metadata", "bronze_since_rows": "bronze_rows",
            "quality_stream_rows": "silver_rows", "hourly_late": "hourly_stream"}
    return found | PLAIN | {name: found[other] for name, other in same.items()}
