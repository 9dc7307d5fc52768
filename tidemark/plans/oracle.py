"""Plain SQL for every registered query, written from the definitions and not from the jobs."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"


def half_up(value: str, digits: int) -> str:
    """Round the shown decimal value half up, where ties are common and floats land on either side."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 20)), {digits}) AS DOUBLE)"


PARTS = {
    "prices": """SELECT event_id, event_type AS crypto_id, value AS price_usd, value * 1e6 AS market_cap_usd,
        CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) - 50 AS DOUBLE) AS change_24h_pct,
        ts AS event_timestamp, 'events' AS source FROM events""",
    "assets": """SELECT DISTINCT event_type AS crypto_id, upper(substr(event_type, 1, 3)) AS symbol,
        'Cryptocurrency' AS category,
        CASE WHEN event_type < 'f' THEN 'Proof of Work' ELSE 'Proof of Stake' END AS consensus_mechanism
        FROM events""",
    "alerts": """SELECT crypto_id, CASE WHEN change_24h_pct > 10 THEN 'PUMP' ELSE 'DUMP' END AS alert_type,
        CASE WHEN change_24h_pct > 10 THEN 'Price up more than 10.0% in 24h'
             ELSE 'Price down more than 10.0% in 24h' END AS message,
        price_usd, event_timestamp AS created_at, change_24h_pct
        FROM prices WHERE change_24h_pct > 10 OR change_24h_pct < -10""",
    "rules": """SELECT * FROM (VALUES
        ('A001', 'extreme_pump', 'change_24h_pct', '>', 20.0::DOUBLE, 'CRITICAL'),
        ('A002', 'extreme_dump', 'change_24h_pct', '<', -20.0::DOUBLE, 'CRITICAL'),
        ('A003', 'moderate_pump', 'change_24h_pct', '>', 10.0::DOUBLE, 'HIGH'),
        ('A004', 'moderate_dump', 'change_24h_pct', '<', -10.0::DOUBLE, 'HIGH'))
        AS r(rule_id, name, metric, operator, threshold, severity)""",
    "tiered": """SELECT r.*, p.change_24h_pct AS triggered_value, p.crypto_id, p.event_timestamp AS triggered_at,
        p.price_usd, p.change_24h_pct FROM prices p JOIN rules r
        ON (r.operator = '>' AND p.change_24h_pct > r.threshold)
        OR (r.operator = '<' AND p.change_24h_pct < r.threshold)""",
    "parsed": """SELECT event_id,
        CASE m WHEN 1 THEN NULL WHEN 3 THEN 'unknown_coin' ELSE crypto_id END AS crypto_id,
        CASE m WHEN 2 THEN -price_usd WHEN 5 THEN 2e7 WHEN 8 THEN NULL ELSE price_usd END AS price_usd,
        market_cap_usd,
        CASE m WHEN 6 THEN 5000.0 ELSE change_24h_pct END AS change_24h_pct,
        CASE m WHEN 4 THEN 'not-a-date' WHEN 7 THEN '10:00' WHEN 9 THEN NULL
             ELSE strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%f+00:00') END AS "timestamp",
        source, event_timestamp AS received_at
        FROM (SELECT *, event_id % 17 AS m FROM prices)""",
    "checked": """SELECT *,
        crypto_id IS NOT NULL AND price_usd IS NOT NULL AND "timestamp" IS NOT NULL AS required_fields,
        coalesce(price_usd > 0, false) AS price_positive,
        coalesce(crypto_id IN ('click', 'error', 'purchase', 'signup', 'view'), false) AS valid_crypto,
        coalesce(regexp_matches("timestamp", '^[0-9]{4}-[0-9]{2}-[0-9]{2}'), false)
            AND try_cast("timestamp" AS TIMESTAMPTZ) IS NOT NULL AS timestamp_format,
        coalesce(price_usd BETWEEN 0.0001 AND 10000000, false) AS price_range,
        change_24h_pct IS NULL OR change_24h_pct BETWEEN -99 AND 1000 AS change_range
        FROM parsed""",
    "validated": """SELECT *,
        required_fields AND price_positive AND valid_crypto AND timestamp_format AND price_range
            AND change_range AS valid,
        list_filter([
            CASE WHEN NOT required_fields THEN 'Missing required fields: [' || array_to_string(list_filter([
                CASE WHEN crypto_id IS NULL THEN '''crypto_id''' END,
                CASE WHEN price_usd IS NULL THEN '''price_usd''' END,
                CASE WHEN "timestamp" IS NULL THEN '''timestamp''' END], lambda x: x IS NOT NULL), ', ') || ']' END,
            CASE WHEN NOT price_positive THEN 'price_usd must be positive, got ' || CAST(price_usd AS VARCHAR) END,
            CASE WHEN NOT valid_crypto THEN 'Unknown crypto_id: ' || coalesce(crypto_id, 'None') END,
            CASE WHEN NOT timestamp_format THEN 'Invalid timestamp format: ' || "timestamp" END,
            CASE WHEN NOT price_range
                THEN 'price_usd ' || CAST(price_usd AS VARCHAR) || ' out of range [0.0001, 10000000]' END,
            CASE WHEN NOT change_range
                THEN 'change_24h_pct ' || CAST(change_24h_pct AS VARCHAR) || ' out of range [-99, 1000]' END
        ], lambda x: x IS NOT NULL) AS errors FROM checked""",
    "letters": """SELECT coalesce(crypto_id, 'unknown') AS crypto_id, '[' || array_to_string(errors, ', ') || ']' AS error,
        'validate' AS step, received_at AS failed_at, CAST(CAST(received_at AS DATE) AS VARCHAR) AS date
        FROM validated WHERE NOT valid""",
    "windows": """SELECT crypto_id, time_bucket(INTERVAL 1 HOUR, event_timestamp) AS window_start,
        time_bucket(INTERVAL 1 HOUR, event_timestamp) + INTERVAL 1 HOUR AS window_end,
        avg(price_usd) AS avg_price, min(price_usd) AS min_price, max(price_usd) AS max_price,
        max(price_usd) - min(price_usd) AS price_range, avg(change_24h_pct) AS avg_change_24h,
        count(*) AS record_count FROM prices GROUP BY ALL""",
    "days": """SELECT CAST(unnest(generate_series((SELECT min(ts)::DATE FROM events), (SELECT max(ts)::DATE FROM events),
        INTERVAL 1 DAY)) AS DATE) AS date""",
    "hours": "SELECT date, unnest(range(24)) AS hour FROM days",
    "latest": """SELECT crypto_id, price_usd, change_24h_pct, event_timestamp FROM prices
        QUALIFY row_number() OVER (PARTITION BY crypto_id ORDER BY event_timestamp DESC) = 1""",
    "stepmetrics": """SELECT list_extract(['consume', 'validate', 'postgres', 's3', 'alert', 'spark_process'],
            CAST(user_id % 6 + 1 AS INTEGER)) AS step, user_id % 6 AS step_order, event_type AS crypto_id,
        CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) < 8 THEN 'failure' ELSE 'success' END AS status,
        value / 100 AS duration_seconds, ts AS recorded_at FROM events""",
    "slas": """SELECT * FROM (VALUES ('S001', 'producer_latency', 60, 'Price fetched within 60s'),
        ('S002', 'consumer_latency', 30, 'Event processed within 30s'),
        ('S003', 's3_upload_latency', 10, 'S3 upload within 10s'),
        ('S004', 'postgres_insert_latency', 5, 'DB insert within 5s'),
        ('S005', 'dashboard_refresh', 60, 'Dashboard refreshes within 60s'),
        ('S006', 'alert_delivery', 30, 'Alert delivered within 30s'))
        AS v(sla_id, name, max_seconds, description)""",
    "slametrics": """SELECT m.sla_id, actual_seconds, coalesce(v.max_seconds, 0) AS max_seconds,
        actual_seconds <= coalesce(v.max_seconds, 0) AS met, recorded_at, v.sla_id IS NOT NULL AS known
        FROM (SELECT CASE WHEN user_id % 7 = 0 THEN 'S099' ELSE 'S00' || (user_id % 6 + 1) END AS sla_id,
              value AS actual_seconds, ts AS recorded_at FROM events) m LEFT JOIN slas v ON m.sla_id = v.sla_id""",
    "compliance": """SELECT v.sla_id, v.name, v.description, count(m.sla_id) AS total,
        count(*) FILTER (m.met) AS met, count(m.sla_id) - count(*) FILTER (m.met) AS breached,
        CASE WHEN count(m.sla_id) = 0 THEN 100.0
             ELSE round(count(*) FILTER (m.met) / count(m.sla_id) * 100.0, 1) END AS compliance_pct
        FROM slas v LEFT JOIN slametrics m ON m.sla_id = v.sla_id GROUP BY ALL""",
    "hourlyquality": """SELECT CAST(h.date AS VARCHAR) AS date, h.hour, count(v.event_id) AS total_events,
        count(*) FILTER (v.valid) AS valid_events, count(v.event_id) - count(*) FILTER (v.valid) AS invalid_events,
        CASE WHEN count(v.event_id) = 0 THEN 100.0
             ELSE round(count(*) FILTER (v.valid) / count(v.event_id) * 100.0, 1) END AS quality_score_pct
        FROM hours h LEFT JOIN validated v
          ON CAST(v.received_at AS DATE) = h.date AND hour(v.received_at) = h.hour
        GROUP BY h.date, h.hour""",
    "dailyquality": """SELECT date, sum(total_events)::BIGINT AS total_events, sum(valid_events)::BIGINT AS valid_events,
        sum(invalid_events)::BIGINT AS invalid_events,
        CASE WHEN sum(total_events) = 0 THEN 100.0
             ELSE round(sum(valid_events) / sum(total_events) * 100.0, 1) END AS quality_score_pct
        FROM hourlyquality GROUP BY date""",
    "exactmart": """SELECT p.crypto_id, p.trade_date, avg_price, min_price, max_price, n AS total_volume,
        coalesce(m, 0) AS alert_count FROM
        (SELECT crypto_id, CAST(event_timestamp AS DATE) AS trade_date, avg(price_usd) AS avg_price,
                min(price_usd) AS min_price, max(price_usd) AS max_price, count(*) AS n FROM prices GROUP BY ALL) p
        LEFT JOIN (SELECT crypto_id, CAST(created_at AS DATE) AS trade_date, count(*) AS m FROM alerts GROUP BY ALL) a
        USING (crypto_id, trade_date)""",
    "headlines": "SELECT doc_id, lang AS crypto_id, text AS headline FROM documents",
    "classified": """SELECT doc_id, crypto_id, CASE WHEN good AND NOT bad THEN 'positive'
        WHEN bad AND NOT good THEN 'negative' ELSE 'neutral' END AS sentiment FROM
        (SELECT *, regexp_matches(lower(headline), 'bullish|surge|rise|gain|up|record|buy|pump|moon') AS good,
                   regexp_matches(lower(headline), 'bearish|crash|fall|drop|down|sell|dump|ban|hack') AS bad
         FROM headlines)""",
    "scores": """SELECT *, CASE WHEN s > 20 THEN 'BULLISH' WHEN s < -20 THEN 'BEARISH' ELSE 'NEUTRAL' END AS sentiment_label
        FROM (SELECT crypto_id, count(*) FILTER (sentiment = 'positive') AS positive_count,
                count(*) FILTER (sentiment = 'negative') AS negative_count,
                count(*) FILTER (sentiment = 'neutral') AS neutral_count, count(*) AS total_headlines,
                (count(*) FILTER (sentiment = 'positive') - count(*) FILTER (sentiment = 'negative'))
                    / count(*) * 100 AS s FROM classified GROUP BY crypto_id)""",
    "holdings": """SELECT * FROM (VALUES ('click', 0.5::DOUBLE), ('error', 0.3::DOUBLE), ('purchase', 0.1::DOUBLE),
        ('signup', 0.05::DOUBLE), ('view', 0.05::DOUBLE)) AS h(crypto_id, allocation)""",
    "ago": """SELECT crypto_id, price_usd, event_timestamp FROM prices
        WHERE event_timestamp BETWEEN TIMESTAMP '2024-01-29 23:00:00' AND TIMESTAMP '2024-01-30 01:00:00'
        QUALIFY row_number() OVER (PARTITION BY crypto_id ORDER BY event_timestamp DESC) = 1""",
    "fresh": """SELECT crypto_id, hours_since_update, hours < 2 AS is_fresh FROM
        (SELECT crypto_id, (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(event_timestamp))) / 1e6 / 3600 AS hours,
         round((epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(event_timestamp))) / 1e6 / 3600, 3) AS hours_since_update
         FROM prices GROUP BY crypto_id)""",
    "present": """SELECT DISTINCT crypto_id, CAST(event_timestamp AS DATE) AS date, 'raw' AS dataset FROM prices
        UNION ALL SELECT DISTINCT crypto_id, CAST(window_start AS DATE), 'aggregations' FROM windows
        UNION ALL SELECT crypto_id, CAST(event_timestamp AS DATE), 'technical' FROM prices
            GROUP BY 1, 2 HAVING count(*) >= 70
        UNION ALL SELECT DISTINCT crypto_id, CAST(recorded_at AS DATE), 'monitoring' FROM stepmetrics
            WHERE status = 'failure' AND step = 'alert'""",
    "complete": """SELECT crypto_id, CAST(date AS VARCHAR) AS date,
        round((5 - len(missing)) / 5 * 100, 1) AS completeness_pct, array_to_string(missing, ',') AS missing,
        len(missing) AS lacking FROM
        (SELECT s.crypto_id, s.date, list(e.dataset ORDER BY e.pos) FILTER (p.dataset IS NULL) AS missing
         FROM (SELECT crypto_id, date FROM assets, days) s
         CROSS JOIN (VALUES (1, 'raw'), (2, 'aggregations'), (3, 'sentiment'), (4, 'technical'), (5, 'monitoring'))
             AS e(pos, dataset)
         LEFT JOIN present p ON p.crypto_id = s.crypto_id AND p.date = s.date AND p.dataset = e.dataset
         GROUP BY s.crypto_id, s.date)""",
    "odd": """SELECT p.crypto_id, count(*) FILTER (abs(price_usd - m) > 3 * sd AND n >= 3) AS anomaly_count,
        round(count(*) FILTER (abs(price_usd - m) > 3 * sd AND n >= 3) / count(*) * 100, 2) AS anomaly_pct
        FROM prices p JOIN (SELECT crypto_id, avg(price_usd) AS m, stddev_pop(price_usd) AS sd, count(*) AS n
                            FROM prices GROUP BY 1) s USING (crypto_id) GROUP BY 1""",
    "observed": """SELECT f.crypto_id, hours_since_update, is_fresh, completeness_pct, missing, lacking,
        anomaly_count, anomaly_pct,
        round(CASE WHEN is_fresh THEN 40.0 ELSE 0.0 END + completeness_pct / 100 * 40
              + CASE WHEN anomaly_pct < 5 THEN 20.0 ELSE 10.0 END, 2) AS score
        FROM fresh f JOIN complete c ON c.crypto_id = f.crypto_id AND c.date = (SELECT CAST(max(ts)::DATE AS VARCHAR) FROM events)
        JOIN odd o ON o.crypto_id = f.crypto_id""",
    "closes": """SELECT crypto_id, CAST(event_timestamp AS DATE) AS date, arg_max(price_usd, event_timestamp) AS close
        FROM prices WHERE CAST(event_timestamp AS DATE) > DATE '2023-12-31' GROUP BY ALL""",
    "pairs": """SELECT a.crypto_id AS crypto1, b.crypto_id AS crypto2, corr(a.close, b.close) AS correlation
        FROM closes a JOIN closes b ON a.date = b.date AND a.crypto_id < b.crypto_id GROUP BY 1, 2""",
    "returns": """SELECT n.crypto_id, n.date, n.close / b.close - 1 AS r FROM closes n JOIN closes b
        ON b.crypto_id = n.crypto_id AND b.date = n.date - 1""",
    "objects": """SELECT prefix, prefix || 'page_' || page_id AS key, size, last_modified FROM
        (SELECT page_id, list_extract(['raw/', 'processed/', 'monitoring/', 'cache/'], CAST(page_id % 4 + 1 AS INTEGER)) AS prefix,
         CAST(length(html) AS BIGINT) AS size,
         TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(page_id % 60 AS INTEGER)) AS last_modified FROM pages)""",
    "cached": """SELECT 'key_' || event_id AS key, ts AS cached_at, ts + to_seconds(k * 21600) AS expires_at,
        k * 21600 AS ttl_seconds FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
    "entries": """SELECT md5(event_type || 'r' || (user_id % 5) || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00')) AS audit_id,
        event_type AS action, 'r' || (user_id % 5) AS resource, 'user-' || user_id AS actor, 'success' AS status,
        ts AS "timestamp", CAST(CAST(ts AS DATE) AS VARCHAR) AS date FROM events""",
    "snapshots": """SELECT *, substr(md5(crypto_id || date || data), 1, 8) AS version_id FROM
        (SELECT CAST(CAST(event_timestamp AS DATE) AS VARCHAR) AS date, 'consume' AS step, crypto_id,
         '{"change_24h_pct":' || CAST(change_24h_pct AS VARCHAR) || ',"crypto_id":"' || crypto_id || '","price_usd":'
             || CAST(price_usd AS VARCHAR) || '}' AS data, event_timestamp AS created_at FROM prices)""",
    "history": """SELECT crypto_id, price_usd, TIMESTAMP '1970-01-01 00:00:00' + to_milliseconds(ms + i) AS event_timestamp
        FROM (SELECT crypto_id, price_usd, epoch_us(event_timestamp) // 1000 AS ms, unnest([0, 1]) AS i FROM prices)""",
    "newhistory": """SELECT DISTINCT ON (h.crypto_id, h.event_timestamp) h.* FROM history h WHERE NOT EXISTS
        (SELECT 1 FROM prices s WHERE s.event_timestamp < TIMESTAMP '2024-01-16 00:00:00'
         AND s.crypto_id = h.crypto_id AND date_trunc('millisecond', s.event_timestamp) = h.event_timestamp)""",
    "numbered": """SELECT crypto_id, event_timestamp, price_usd,
        row_number() OVER (PARTITION BY crypto_id ORDER BY event_timestamp) AS rn,
        price_usd - lag(price_usd) OVER (PARTITION BY crypto_id ORDER BY event_timestamp) AS move FROM prices""",
    "framed": """SELECT crypto_id, event_timestamp, rn, price_usd, avg(price_usd) OVER w AS m, stddev_samp(price_usd) OVER w AS sd
        FROM numbered WINDOW w AS (PARTITION BY crypto_id ORDER BY event_timestamp ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""",
    "wilder": """SELECT crypto_id, 15::BIGINT AS rn, avg(greatest(move, 0)) AS g, avg(greatest(-move, 0)) AS l
        FROM numbered WHERE rn BETWEEN 2 AND 15 GROUP BY crypto_id HAVING count(*) = 14
        UNION ALL SELECT n.crypto_id, n.rn, (w.g * 13 + greatest(n.move, 0)) / 14, (w.l * 13 + greatest(-n.move, 0)) / 14
        FROM wilder w JOIN numbered n ON n.crypto_id = w.crypto_id AND n.rn = w.rn + 1""",
    "strength": """SELECT crypto_id, rn, CASE WHEN l = 0 THEN 100.0 ELSE 100.0 - 100.0 / (1.0 + g / l) END AS rsi
        FROM wilder WHERE rn >= 16""",
    "averages": """SELECT crypto_id, rn, price_usd AS f, price_usd AS s, 0.0::DOUBLE AS line, 0.0::DOUBLE AS sig
        FROM numbered WHERE rn = 1
        UNION ALL SELECT crypto_id, rn, f, s, f - s, 2.0 / 10 * (f - s) + (1 - 2.0 / 10) * sig FROM
        (SELECT n.crypto_id, n.rn, a.sig, 2.0 / 13 * n.price_usd + (1 - 2.0 / 13) * a.f AS f,
                2.0 / 27 * n.price_usd + (1 - 2.0 / 27) * a.s AS s
         FROM averages a JOIN numbered n ON n.crypto_id = a.crypto_id AND n.rn = a.rn + 1)""",
    "replayed": """SELECT step, CASE step
            WHEN 'validate' THEN CASE WHEN valid THEN 'valid' ELSE 'failed' END
            WHEN 'postgres' THEN CASE WHEN crypto_id IS NOT NULL AND timestamp_format THEN 'stored' ELSE 'failed' END
            WHEN 's3' THEN 'stored'
            WHEN 'alert' THEN CASE WHEN change_24h_pct > 10 THEN 'PUMP' WHEN change_24h_pct < -10 THEN 'DUMP'
                                   WHEN change_24h_pct IS NOT NULL THEN 'no_alert' ELSE 'failed' END
            ELSE 'failed' END AS outcome
        FROM (SELECT *, list_extract(['validate', 'postgres', 's3', 'alert', 'other'], CAST(event_id % 5 + 1 AS INTEGER)) AS step
              FROM validated)""",
}

_NEEDS = {
    "alerts": ["prices"],
    "tiered": ["prices", "rules"],
    "parsed": ["prices"],
    "checked": ["parsed"],
    "validated": ["checked"],
    "letters": ["validated"],
    "windows": ["prices"],
    "hours": ["days"],
    "latest": ["prices"],
    "slametrics": ["slas"],
    "compliance": ["slametrics"],
    "hourlyquality": ["hours", "validated"],
    "dailyquality": ["hourlyquality"],
    "exactmart": ["alerts"],
    "classified": ["headlines"],
    "scores": ["classified"],
    "ago": ["prices"],
    "fresh": ["prices"],
    "present": ["windows", "stepmetrics"],
    "complete": ["assets", "days", "present"],
    "odd": ["prices"],
    "observed": ["fresh", "complete", "odd"],
    "closes": ["prices"],
    "pairs": ["closes"],
    "returns": ["closes"],
    "snapshots": ["prices"],
    "history": ["prices"],
    "newhistory": ["history"],
    "numbered": ["prices"],
    "framed": ["numbered"],
    "wilder": ["numbered"],
    "strength": ["wilder"],
    "averages": ["numbered"],
    "replayed": ["validated"],
}


def _with(*names: str) -> str:
    """WITH clause of the named parts and all they are built on."""
    order: list[str] = []

    def visit(name: str) -> None:
        for need in _NEEDS.get(name, []):
            visit(need)
        if name not in order:
            order.append(name)

    for n in names:
        visit(n)
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({PARTS[n]})" for n in order) + "\n"


def sql(name: str, parts: str, body: str) -> None:
    ORACLE[name] = (_with(*parts.split()) if parts else "") + body


# ---- sources, sinks -----------------------------------------------------------------------
sql("parse_events", "parsed", """SELECT event_id, crypto_id, price_usd, market_cap_usd, change_24h_pct, "timestamp", source FROM parsed""")
sql("flatten_quotes", "prices", """SELECT event_id, crypto_id, price_usd,
    CASE WHEN change_24h_pct >= 0 THEN market_cap_usd END AS market_cap_usd, change_24h_pct, event_timestamp,
    'coingecko' AS source FROM prices""")
sql("backfill_events", "history", """SELECT crypto_id, price_usd, CAST(NULL AS DOUBLE) AS market_cap_usd,
    CAST(NULL AS DOUBLE) AS change_24h_pct, event_timestamp, 'coingecko_historical' AS source FROM history""")
sql("backfill_plan", "prices", f"""SELECT crypto_id, count(*) AS planned_events, true AS to_lake, true AS to_table
    FROM prices WHERE event_timestamp >= {AS_OF} - INTERVAL 30 DAY GROUP BY crypto_id""")
sql("recent_prices", "prices", f"""SELECT crypto_id, price_usd, market_cap_usd, change_24h_pct, event_timestamp, source
    FROM prices WHERE event_timestamp >= {AS_OF} - INTERVAL 24 HOUR ORDER BY event_timestamp, crypto_id""")
sql("recent_alerts", "alerts", f"""SELECT crypto_id, alert_type, message, price_usd, created_at
    FROM alerts WHERE created_at >= {AS_OF} - INTERVAL 24 HOUR ORDER BY created_at, crypto_id""")
sql("dlq_scan", "letters", "SELECT * FROM letters WHERE date = '2024-01-15' AND step = 'validate'")
sql("dlq_records", "letters", "SELECT * FROM letters")
sql("audit_logs", "entries", "SELECT * FROM entries WHERE action = 'click' AND resource = 'r1'")
sql("audit_entries", "entries", "SELECT * FROM entries")
sql("price_matrix", "closes", """SELECT CAST(d.date AS VARCHAR) AS date,
    max(close) FILTER (crypto_id = 'click') AS click, max(close) FILTER (crypto_id = 'error') AS error,
    max(close) FILTER (crypto_id = 'purchase') AS purchase, max(close) FILTER (crypto_id = 'signup') AS signup,
    max(close) FILTER (crypto_id = 'view') AS view
    FROM (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS date) d
    LEFT JOIN closes c ON c.date = d.date GROUP BY d.date ORDER BY 1""")
sql("last_n_prices", "prices", """SELECT crypto_id, event_timestamp, price_usd FROM prices
    QUALIFY row_number() OVER (PARTITION BY crypto_id ORDER BY event_timestamp DESC) <= 200 ORDER BY 1, 2""")
sql("dim_assets", "assets", "SELECT * FROM assets")
sql("raw_partition_keys", "parsed", """SELECT replace(substr(coalesce("timestamp", '2024-01-31 00:00:00'), 1, 10), '-', '/') AS date_path,
    coalesce(crypto_id, 'unknown') AS crypto_id, count(*) AS row_count FROM parsed GROUP BY 1, 2""")
sql("agg_partition_keys", "windows", """SELECT strftime(window_start, '%Y/%m/%d') AS date_path, crypto_id, count(*) AS row_count
    FROM windows GROUP BY 1, 2""")
sql("idempotent_insert", "prices", """SELECT crypto_id, event_timestamp, round(price_usd, 6) AS price_usd FROM (
    SELECT crypto_id, event_timestamp, price_usd + 5 AS price_usd FROM prices WHERE event_timestamp < TIMESTAMP '2024-01-16 00:00:00'
    UNION ALL
    SELECT crypto_id, event_timestamp, price_usd FROM (
        SELECT crypto_id, event_timestamp, price_usd, 2 AS arrival FROM prices
        UNION ALL SELECT crypto_id, event_timestamp, price_usd + 1, 1 FROM prices)
    WHERE event_timestamp >= TIMESTAMP '2024-01-16 00:00:00'
    QUALIFY row_number() OVER (PARTITION BY crypto_id, event_timestamp ORDER BY arrival) = 1)""")
sql("backfill_insert_count", "newhistory", "SELECT crypto_id, count(*) AS inserted FROM newhistory GROUP BY 1")
sql("backfill_summary", "newhistory", """SELECT coalesce(crypto_id, 'TOTAL') AS crypto_id, sum(e)::BIGINT AS total_events,
    sum(e)::BIGINT AS saved_lake, sum(n)::BIGINT AS saved_table FROM (
    SELECT crypto_id, 1 AS e, 0 AS n FROM history UNION ALL SELECT crypto_id, 0, 1 FROM newhistory) GROUP BY ROLLUP (crypto_id)""")
sql("sync_prices", "prices", """SELECT crypto_id, price_usd, market_cap_usd, change_24h_pct, event_timestamp,
    CASE WHEN event_timestamp < TIMESTAMP '2024-01-10 00:00:00' THEN 'events' ELSE 'coingecko' END AS source FROM prices""")
sql("sync_alerts", "alerts", "SELECT crypto_id, alert_type, message, price_usd, created_at FROM alerts")
sql("sla_record", "slametrics", "SELECT * FROM slametrics")
sql("snapshot_write", "snapshots", "SELECT * FROM snapshots")
sql("archive_candidates", "objects", f"""SELECT *, regexp_replace(key, '^raw/', 'archive/') AS archive_key FROM objects
    WHERE last_modified < {AS_OF} - INTERVAL 7 DAY""")
sql("cold_manifest", "objects", f"""SELECT key, size, 'COLD' AS target_class FROM objects
    WHERE last_modified < {AS_OF} - INTERVAL 20 DAY""")
sql("ttl_live", "cached", f"SELECT * FROM cached WHERE NOT ({AS_OF} > expires_at)")
sql("ttl_purge_count", "cached", f"""SELECT count(*) FILTER ({AS_OF} > expires_at) AS purged,
    count(*) FILTER (NOT ({AS_OF} > expires_at)) AS kept FROM cached""")

# ---- projections, filters, checks ------------------------------------------------------------
sql("validate_events", "validated", """SELECT event_id, valid, required_fields, price_positive, valid_crypto, timestamp_format,
    price_range, change_range, array_to_string(errors, ' | ') AS errors FROM validated""")
sql("validate_aggregates", "windows", """SELECT crypto_id, window_start, avg_price_positive, price_order, record_count_positive,
    window_order, avg_price_positive AND price_order AND record_count_positive AND window_order AS valid,
    (NOT avg_price_positive)::INT + (NOT price_order)::INT + (NOT record_count_positive)::INT + (NOT window_order)::INT AS error_count
    FROM (SELECT crypto_id, window_start, avg_price > 0 AS avg_price_positive,
        CASE WHEN record_count % 3 = 0 THEN max_price + 1 ELSE min_price END <= avg_price AND avg_price <= max_price AS price_order,
        record_count > 0 AS record_count_positive,
        window_start < CASE WHEN record_count % 7 = 0 THEN window_start ELSE window_end END AS window_order FROM windows)""")
sql("price_alerts", "alerts", "SELECT crypto_id, alert_type, message, price_usd, created_at FROM alerts")
sql("tiered_alerts", "tiered", """SELECT rule_id, name, metric, operator, threshold, severity, triggered_value, crypto_id,
    triggered_at FROM tiered""")
_DERIVED = """hourly AS (SELECT crypto_id, epoch(date_trunc('hour', event_timestamp))::BIGINT // 3600 AS slot, count(*) AS n
    FROM prices GROUP BY 1, 2),
volume AS (SELECT a.crypto_id, a.slot, a.n / (sum(b.n) / 24) AS volume_ratio FROM hourly a
    LEFT JOIN hourly b ON b.crypto_id = a.crypto_id AND b.slot BETWEEN a.slot - 24 AND a.slot - 1 GROUP BY a.crypto_id, a.slot, a.n),
derived AS (SELECT f.crypto_id, f.event_timestamp, CASE WHEN rn >= 20 AND m <> 0 THEN (price_usd / m - 1) * 100 END AS price_vs_sma,
    v.volume_ratio FROM framed f LEFT JOIN volume v
    ON v.crypto_id = f.crypto_id AND v.slot = epoch(date_trunc('hour', f.event_timestamp))::BIGINT // 3600)
"""
ORACLE["derived_metrics"] = _with("framed").rstrip() + ",\n" + _DERIVED + """SELECT crypto_id, event_timestamp,
    round(price_vs_sma, 6) AS price_vs_sma, round(volume_ratio, 6) AS volume_ratio FROM derived"""
ORACLE["tiered_alerts_derived"] = _with("framed", "tiered").rstrip() + ",\n" + _DERIVED + """
SELECT crypto_id, rule_id, severity, count(*) AS alerts FROM (
    SELECT crypto_id, rule_id, severity FROM tiered
    UNION ALL SELECT crypto_id, 'A005', 'MEDIUM' FROM derived WHERE volume_ratio > 2
    UNION ALL SELECT crypto_id, 'A006', 'LOW' FROM derived WHERE price_vs_sma > 5) GROUP BY 1, 2, 3"""
sql("stg_alerts", "alerts", """SELECT crypto_id, alert_type, message, price_usd, created_at, CASE WHEN alert_type = 'PUMP' THEN 'HIGH'
    WHEN alert_type = 'DUMP' THEN 'HIGH' ELSE 'MEDIUM' END AS severity FROM alerts""")
sql("alert_messages", "tiered", """SELECT rule_id, crypto_id, triggered_at, CASE severity WHEN 'CRITICAL' THEN 'danger' WHEN 'HIGH' THEN 'warning'
    WHEN 'MEDIUM' THEN '#439FE0' ELSE 'good' END AS color, '[' || severity || '] ' || name || ' — ' || crypto_id || ' | price=$'
    || format('{:,.2f}', price_usd) || ' | change=' || format('{:+.2f}', change_24h_pct) || '%' AS message FROM tiered""")
sql("price_alert_texts", "alerts", """SELECT crypto_id, created_at, 'danger' AS color, CASE WHEN alert_type = 'PUMP'
    THEN '🚀 PUMP ALERT: ' || crypto_id || ' up ' ELSE '📉 DUMP ALERT: ' || crypto_id || ' down ' END
    || format('{:.2f}', abs(change_24h_pct)) || '% — Current price: $' || format('{:,.2f}', price_usd) AS text FROM alerts""")
sql("prices_recent", "prices", f"""SELECT crypto_id, price_usd, market_cap_usd, change_24h_pct, event_timestamp, source FROM prices
    WHERE crypto_id = 'click' AND event_timestamp >= {AS_OF} - INTERVAL 24 HOUR ORDER BY event_timestamp DESC""")
sql("alerts_recent", "alerts", f"""SELECT crypto_id, alert_type, message, price_usd, created_at FROM alerts
    WHERE crypto_id = 'click' AND created_at >= {AS_OF} - INTERVAL 24 HOUR ORDER BY created_at DESC""")
sql("aggs_recent", "windows", f"""SELECT crypto_id, window_start, window_end, round(avg_price, 6) AS avg_price, min_price, max_price,
    record_count FROM windows WHERE crypto_id = 'click' AND window_start >= {AS_OF} - INTERVAL 24 HOUR ORDER BY window_start DESC""")
sql("dash_prices", "prices", f"""SELECT crypto_id, price_usd, change_24h_pct, event_timestamp FROM prices
    WHERE event_timestamp >= {AS_OF} - INTERVAL 24 HOUR ORDER BY event_timestamp DESC, crypto_id""")
sql("dash_alerts", "alerts", f"""SELECT alert_type, crypto_id, message, created_at FROM alerts
    WHERE created_at >= {AS_OF} - INTERVAL 24 HOUR ORDER BY created_at DESC, crypto_id LIMIT 50""")
sql("dash_aggs", "windows", f"""SELECT crypto_id, window_start, window_end, round(avg_price, 6) AS avg_price, min_price, max_price,
    round(price_range, 6) AS price_range, record_count FROM windows
    WHERE window_start >= {AS_OF} - INTERVAL 24 HOUR ORDER BY window_start DESC, crypto_id LIMIT 50""")
sql("resource_flags", "", """SELECT sample_id, len(w) = 0 AS healthy, array_to_string(w, ' | ') AS warnings FROM (
    SELECT event_id AS sample_id, list_filter([
        CASE WHEN k > 80 THEN 'CPU usage high: ' || format('{:.1f}', k) || '% (threshold 80%)' END,
        CASE WHEN m > 85 THEN 'Memory usage high: ' || format('{:.1f}', r) || '% (threshold 85%)' END,
        CASE WHEN 99 - k > 90 THEN 'Disk usage high: ' || format('{:.1f}', 99 - k) || '% (threshold 90%)' END], lambda x: x IS NOT NULL) AS w
    FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, value % 100 AS m, __R__ AS r FROM events))""".replace("__R__", half_up("value % 100", 1)))
sql("consumer_lag", "validated", """SELECT *, CASE WHEN lag_pct < 5 THEN 'healthy' WHEN lag_pct < 20 THEN 'warning' ELSE 'critical' END AS status
    FROM (SELECT CAST(CAST(received_at AS DATE) AS VARCHAR) AS date, count(*) AS produced, count(*) FILTER (valid) AS consumed,
        count(*) - count(*) FILTER (valid) AS lag,
        round((count(*) - count(*) FILTER (valid)) / count(*) * 100.0, 1) AS lag_pct FROM validated GROUP BY 1)""")
sql("headline_class", "classified", "SELECT * FROM classified")
sql("stg_prices", "prices", """SELECT crypto_id, price_usd, market_cap_usd, change_24h_pct, event_timestamp, source,
    round(c, 6) AS price_change_usd, c > 0 AS is_price_increase FROM (SELECT *, price_usd - lag(price_usd)
    OVER (PARTITION BY crypto_id ORDER BY event_timestamp) AS c FROM prices)""")
sql("not_null_checks", "parsed", """SELECT column_name, null_count, null_count = 0 AS passed FROM (
    SELECT 'crypto_id' AS column_name, count(*) FILTER (crypto_id IS NULL) AS null_count FROM parsed
    UNION ALL SELECT 'price_usd', count(*) FILTER (price_usd IS NULL) FROM parsed
    UNION ALL SELECT 'timestamp', count(*) FILTER ("timestamp" IS NULL) FROM parsed)""")
sql("price_history", "prices", "SELECT event_timestamp, price_usd FROM prices WHERE crypto_id = 'view' ORDER BY event_timestamp")
sql("price_comparison", "latest assets", """SELECT symbol, price_usd FROM latest JOIN assets USING (crypto_id)
    WHERE crypto_id IN ('click', 'view', 'purchase')""")
sql("kpi_row", "latest assets", """SELECT symbol, CASE WHEN price_usd >= 1 THEN '$' || format('{:,.2f}', price_usd)
    ELSE '$' || format('{:.4f}', price_usd) END AS price_text, format('{:+.2f}', change_24h_pct) || '%' AS change_text
    FROM assets JOIN latest USING (crypto_id)""")

# ---- marts and windows --------------------------------------------------------------------------
_WINDOW = f"""{half_up('avg(price_usd)', 6)} AS avg_price, min(price_usd) AS min_price, max(price_usd) AS max_price,
    round(max(price_usd) - min(price_usd), 6) AS price_range, {half_up('avg(change_24h_pct)', 6)} AS avg_change_24h,
    count(*) AS record_count"""
for _name, _size in (("window_agg", "1 HOUR"), ("window_agg_minute", "1 MINUTE")):
    sql(_name, "prices", f"""SELECT crypto_id, time_bucket(INTERVAL {_size}, event_timestamp) AS window_start,
    time_bucket(INTERVAL {_size}, event_timestamp) + INTERVAL {_size} AS window_end, {_WINDOW} FROM prices GROUP BY 1, 2, 3""")
sql("window_sessions", "prices", f"""SELECT crypto_id, min(event_timestamp) AS session_start,
    max(event_timestamp) + INTERVAL 30 MINUTE AS session_end, {half_up('avg(price_usd)', 6)} AS avg_price,
    min(price_usd) AS min_price, max(price_usd) AS max_price, {half_up('avg(change_24h_pct)', 6)} AS avg_change_24h,
    count(*) AS record_count FROM (
        SELECT *, count(*) FILTER (begins) OVER (PARTITION BY crypto_id ORDER BY event_timestamp) AS island FROM (
            SELECT *, coalesce(event_timestamp - lag(event_timestamp) OVER (PARTITION BY crypto_id ORDER BY event_timestamp)
                > INTERVAL 30 MINUTE, true) AS begins FROM prices))
    GROUP BY crypto_id, island""")
sql("window_agg_sliding", "prices", f"""SELECT crypto_id, window_start, window_start + INTERVAL 2 HOUR AS window_end, {_WINDOW}
    FROM (SELECT *, time_bucket(INTERVAL 1 HOUR, event_timestamp) - to_hours(unnest([0, 1])) AS window_start FROM prices)
    GROUP BY 1, 2, 3""")
sql("window_ohlc", "prices", """SELECT crypto_id, time_bucket(INTERVAL 1 HOUR, event_timestamp) AS window_start,
    arg_min(price_usd, event_timestamp) AS open, max(price_usd) AS high, min(price_usd) AS low,
    arg_max(price_usd, event_timestamp) AS close, count(*) AS record_count FROM prices GROUP BY 1, 2""")
sql("fct_daily", "prices", """SELECT crypto_id, CAST(CAST(event_timestamp AS DATE) AS VARCHAR) AS trade_date,
    round(avg(price_usd), 6) AS avg_price, min(price_usd) AS min_price, max(price_usd) AS max_price,
    round(max(price_usd) - min(price_usd), 6) AS price_volatility, count(*) AS event_count,
    round(avg(change_24h_pct), 6) AS avg_change_24h FROM prices GROUP BY 1, 2""")
sql("fct_daily_items", "", f"""SELECT crypto_id, CAST(CAST(event_timestamp AS DATE) AS VARCHAR) AS trade_date,
    {half_up('avg(price_usd)', 6)} AS avg_price, min(price_usd) AS min_price, max(price_usd) AS max_price,
    round(max(price_usd) - min(price_usd), 6) AS price_volatility, count(*) AS event_count,
    {half_up('avg(change_24h_pct)', 6)} AS avg_change_24h FROM (SELECT CAST(l_partkey AS VARCHAR) AS crypto_id,
    l_extendedprice AS price_usd, l_discount * 100 AS change_24h_pct, l_shipdate AS event_timestamp FROM lineitem) GROUP BY 1, 2""")
sql("fct_alerts", "alerts", """SELECT crypto_id, CAST(CAST(created_at AS DATE) AS VARCHAR) AS alert_date, count(*) AS total_alerts,
    count(CASE WHEN alert_type = 'PUMP' THEN 1 END) AS pump_count, count(CASE WHEN alert_type = 'DUMP' THEN 1 END) AS dump_count,
    round(CAST(count(*) / 24.0 AS DOUBLE), 6) AS alert_rate FROM alerts GROUP BY 1, 2""")
sql("daily_mart", "alerts", """SELECT p.crypto_id, CAST(CAST(p.event_timestamp AS DATE) AS VARCHAR) AS trade_date,
    round(avg(p.price_usd), 6) AS avg_price, min(p.price_usd) AS min_price, max(p.price_usd) AS max_price,
    count(*) AS total_volume, count(a.crypto_id) AS alert_count FROM prices p LEFT JOIN alerts a
    ON p.crypto_id = a.crypto_id AND CAST(p.event_timestamp AS DATE) = CAST(a.created_at AS DATE) GROUP BY 1, 2""")
sql("daily_mart_exact", "exactmart", """SELECT crypto_id, CAST(trade_date AS VARCHAR) AS trade_date, round(avg_price, 6) AS avg_price,
    min_price, max_price, total_volume, alert_count FROM exactmart""")
sql("daily_mart_upsert", "exactmart", """SELECT crypto_id, CAST(trade_date AS VARCHAR) AS trade_date, round(avg_price, 6) AS avg_price,
    min_price, max_price, CASE WHEN trade_date < DATE '2024-01-10' THEN -1 ELSE total_volume END AS total_volume, alert_count
    FROM exactmart""")
sql("latest_prices", "latest", "SELECT * FROM latest")
sql("asset_summary", "assets alerts windows latest", f"""SELECT s.crypto_id, l.price_usd, l.event_timestamp AS price_timestamp,
    a.alert_type, a.message AS alert_message, a.created_at AS alert_created_at, round(w.avg_price, 6) AS avg_price, w.window_start
    FROM assets s LEFT JOIN latest l USING (crypto_id)
    LEFT JOIN (SELECT * FROM alerts WHERE created_at >= {AS_OF} - INTERVAL 24 HOUR
        QUALIFY row_number() OVER (PARTITION BY crypto_id ORDER BY created_at DESC) = 1) a USING (crypto_id)
    LEFT JOIN (SELECT * FROM windows WHERE window_start >= {AS_OF} - INTERVAL 1 HOUR
        QUALIFY row_number() OVER (PARTITION BY crypto_id ORDER BY window_start DESC) = 1) w USING (crypto_id)""")
sql("dashboard_latest", "assets latest", """SELECT crypto_id, price_usd, change_24h_pct, event_timestamp AS last_updated
    FROM assets LEFT JOIN latest USING (crypto_id)""")

# ---- alert reports --------------------------------------------------------------------------------
sql("suppress_alerts", "tiered", """SELECT rule_id, crypto_id, triggered_at, EXISTS (SELECT 1 FROM tiered b
    WHERE b.rule_id = t.rule_id AND b.crypto_id = t.crypto_id AND b.triggered_at < t.triggered_at
    AND b.triggered_at > t.triggered_at - INTERVAL 30 MINUTE) AS suppressed FROM tiered t""")
sql("alerts_by_hour", "tiered", "SELECT strftime(triggered_at, '%H') AS hour, count(*) AS alerts FROM tiered GROUP BY 1")
sql("peak_hour", "tiered", """SELECT strftime(triggered_at, '%H') AS peak_hour, count(*) AS alerts FROM tiered GROUP BY 1
    ORDER BY 2 DESC, 1 LIMIT 1""")
sql("alert_patterns", "tiered", """SELECT kind, key, alerts,
    row_number() OVER (PARTITION BY kind ORDER BY alerts DESC, key) = 1 AS is_top FROM (
    SELECT kind, key, sum(n)::BIGINT AS alerts FROM (
        SELECT 'crypto' AS kind, crypto_id AS key, 1 AS n FROM tiered WHERE triggered_at >= TIMESTAMP '2024-01-01 00:00:00'
        UNION ALL SELECT 'rule', rule_id, 1 FROM tiered WHERE triggered_at >= TIMESTAMP '2024-01-01 00:00:00'
        UNION ALL SELECT 'day', CAST(CAST(triggered_at AS DATE) AS VARCHAR), 1 FROM tiered WHERE triggered_at >= TIMESTAMP '2024-01-01 00:00:00'
        UNION ALL SELECT 'day', CAST(CAST(d AS DATE) AS VARCHAR), 0
            FROM (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS d)) GROUP BY 1, 2)""")
sql("alert_statistics", "tiered", """SELECT 'severity' AS kind, severity AS key, count(*) AS alerts FROM tiered GROUP BY severity
    UNION ALL SELECT 'crypto', crypto_id, count(*) FROM tiered GROUP BY crypto_id
    UNION ALL SELECT 'total', 'all', count(*) FROM tiered""")
sql("alert_digest", "tiered", """SELECT *, 'Today: ' || total || ' alerts (' || critical || ' CRITICAL, ' || high || ' HIGH)' AS digest FROM (
    SELECT count(*) AS total, count(*) FILTER (severity = 'CRITICAL') AS critical, count(*) FILTER (severity = 'HIGH') AS high FROM tiered)""")

# ---- quality, steps, service levels ----------------------------------------------------------------
_STATS = f"""count(m.status) AS total_events, count(*) FILTER (m.status = 'success') AS success_count,
    count(m.status) - count(*) FILTER (m.status = 'success') AS failure_count,
    coalesce(round(count(*) FILTER (m.status = 'success') / nullif(count(m.status), 0) * 100.0, 2), 0.0) AS success_rate_pct,
    coalesce({half_up('avg(m.duration_seconds)', 4)}, 0.0) AS avg_duration_seconds,
    coalesce(round(max(m.duration_seconds), 4), 0.0) AS max_duration_seconds,
    coalesce(round(min(m.duration_seconds), 4), 0.0) AS min_duration_seconds"""
_SIX = "(SELECT unnest(['consume', 'validate', 'postgres', 's3', 'alert', 'spark_process']) AS step)"
sql("step_stats", "stepmetrics", f"SELECT s.step, {_STATS} FROM {_SIX} s LEFT JOIN stepmetrics m ON m.step = s.step GROUP BY s.step")
sql("hourly_report", "hours stepmetrics", f"""SELECT CAST(h.date AS VARCHAR) AS date, h.hour, s.step, {_STATS}
    FROM hours h CROSS JOIN {_SIX} s LEFT JOIN stepmetrics m
    ON m.step = s.step AND CAST(m.recorded_at AS DATE) = h.date AND hour(m.recorded_at) = h.hour GROUP BY h.date, h.hour, s.step""")
_DATED = "(SELECT *, CAST(CAST(recorded_at AS DATE) AS VARCHAR) AS date FROM stepmetrics)"
sql("daily_report", "stepmetrics", f"""SELECT r.*, t.step AS slowest_step FROM (
    SELECT date, step, {_STATS} FROM {_DATED} m GROUP BY 1, 2 UNION ALL SELECT date, 'ALL', {_STATS} FROM {_DATED} m GROUP BY 1) r
    JOIN (SELECT date, step FROM {_DATED} GROUP BY date, step, step_order QUALIFY row_number()
        OVER (PARTITION BY date ORDER BY {half_up('avg(duration_seconds)', 4)} DESC, step_order) = 1) t USING (date)""")
sql("sla_compliance", "compliance", "SELECT * FROM compliance")
sql("sla_overall", "compliance", "SELECT round(avg(compliance_pct), 1) AS overall_compliance_pct FROM compliance")
sql("quality_hourly", "hourlyquality", "SELECT * FROM hourlyquality")
sql("quality_daily", "dailyquality", "SELECT * FROM dailyquality")
sql("quality_alert", "dailyquality", """SELECT date, quality_score_pct, CASE WHEN quality_score_pct < 50 THEN 'Quality alert: score '
    || format('{:.1f}', quality_score_pct) || '% is below threshold 50.0%' END AS alert FROM dailyquality""")
_TREND = """SELECT CASE WHEN days >= 2 AND recent > older + {m} THEN 'improving' WHEN days >= 2 AND recent < older - {m} THEN '{f}'
    ELSE 'stable' END AS trend, round(a, {d}) AS avg_score, days FROM (
    SELECT count(*) AS days, avg(s) AS a, avg(s) FILTER (n <= 3) AS recent, avg(s) FILTER (o <= 3) AS older FROM (
        SELECT s, row_number() OVER (ORDER BY date DESC) AS n, row_number() OVER (ORDER BY date) AS o FROM ({src})
        WHERE date > (SELECT CAST(max(ts)::DATE - 7 AS VARCHAR) FROM events)
            AND date <= (SELECT CAST(max(ts)::DATE AS VARCHAR) FROM events)))"""
sql("quality_trend", "dailyquality", _TREND.format(m=2, f="declining", d=1, src="SELECT date, quality_score_pct AS s FROM dailyquality"))
sql("health_trend", "stepmetrics", _TREND.format(m=5, f="degrading", d=2, src="""SELECT CAST(CAST(recorded_at AS DATE) AS VARCHAR) AS date,
    round(count(*) FILTER (status = 'success') / count(*) * 100.0, 2) AS s FROM stepmetrics GROUP BY 1"""))
sql("stream_quality", "validated", """SELECT total, quality_score, CASE WHEN quality_score < 80 THEN 'Quality score '
    || format('{:.1f}', __R__) || '% below 80% threshold' END AS warning FROM (
    SELECT count(*) AS total, round(count(*) FILTER (valid) / count(*) * 100.0, 6) AS quality_score FROM validated)""".replace("__R__", half_up("quality_score", 1)))
sql("validation_summary", "validated", """SELECT count(*) AS total, count(*) FILTER (valid) AS valid, count(*) FILTER (NOT valid) AS invalid,
    round(count(*) FILTER (valid) / count(*) * 100.0, 6) AS quality_score, sum(len(errors))::BIGINT AS error_count FROM validated""")
sql("validation_errors", "validated", "SELECT event_id, unnest(errors) AS error FROM validated")
sql("error_counts", "validated", " UNION ALL ".join(
    f"SELECT '{c}' AS \"check\", count(*) FILTER (NOT {c}) AS failures FROM validated"
    for c in ("required_fields", "price_positive", "valid_crypto", "timestamp_format", "price_range", "change_range")))
sql("run_summary", "validated", """SELECT count(*) AS total_events, count(*) FILTER (valid) AS valid_events,
    count(*) FILTER (NOT valid) AS invalid_events, count(*) FILTER (valid AND abs(change_24h_pct) > 10) AS alerts_triggered,
    count(*) FILTER (NOT valid) AS dlq_events, round(count(*) FILTER (valid) / count(*) * 100.0, 6) AS quality_score FROM validated""")
sql("dlq_replay", "replayed", """SELECT step, outcome, count(*) AS total, count(*) FILTER (outcome <> 'failed') AS replayed,
    count(*) FILTER (outcome = 'failed') AS still_failing FROM replayed GROUP BY 1, 2""")
sql("throughput", "", """SELECT *, round(mb_per_second * 86400 / 1024, 2) AS gb_per_day FROM (
    SELECT hour, round(r, 6) AS messages_per_second, round(k, 6) AS avg_message_size_kb, round(r * k / 1024, 4) AS mb_per_second FROM (
    SELECT date_trunc('hour', ts) AS hour, count(*) / 3600.0::DOUBLE AS r, avg(strlen(props)) / 1024.0::DOUBLE AS k FROM events GROUP BY 1))""")

# ---- sentiment, portfolio ------------------------------------------------------------------------------
sql("sentiment", "scores", """SELECT crypto_id, positive_count, negative_count, neutral_count, total_headlines,
    round(s, 2) AS sentiment_score, sentiment_label FROM scores""")
sql("sentiment_summary", "scores", """SELECT l AS sentiment_label, count(s.crypto_id) AS assets
    FROM (SELECT unnest(['BULLISH', 'BEARISH', 'NEUTRAL']) AS l) LEFT JOIN scores s ON s.sentiment_label = l GROUP BY 1""")
sql("portfolio_value", "holdings latest", """SELECT crypto_id, round(allocation * 10000, 2) AS value,
    round(allocation * 10000 / (SELECT sum(allocation * 10000) FROM holdings) * 100, 4) AS weight_pct, price_usd AS current_price,
    round((SELECT sum(allocation * 10000) FROM holdings), 2) AS total_value, 'click' AS top_holding
    FROM holdings LEFT JOIN latest USING (crypto_id)""")
sql("portfolio_market_value", "holdings prices", """SELECT crypto_id, round(allocation * 10000 / f, 6) AS units,
    round(allocation * 10000 / f * l, 6) AS market_value FROM holdings LEFT JOIN (SELECT crypto_id,
    arg_min(price_usd, event_timestamp) AS f, arg_max(price_usd, event_timestamp) AS l FROM prices GROUP BY 1) USING (crypto_id)""")
sql("price_24h_ago", "ago", "SELECT * FROM ago")
ORACLE["portfolio_returns"] = _with("holdings", "latest", "ago").rstrip() + """,
single AS (SELECT h.crypto_id, h.allocation, coalesce(CASE WHEN a.price_usd > 0
    THEN round((coalesce(l.price_usd, 0) - a.price_usd) / a.price_usd * 100, 4) END, 0.0) AS return_pct
    FROM holdings h LEFT JOIN latest l USING (crypto_id) LEFT JOIN ago a USING (crypto_id))
SELECT crypto_id, round(allocation, 6) AS allocation, return_pct FROM single
UNION ALL SELECT 'TOTAL', round(sum(allocation), 6), round(sum(allocation * return_pct), 4) FROM single"""

# ---- observatory -----------------------------------------------------------------------------------------
sql("freshness", "fresh", "SELECT * FROM fresh")
sql("completeness", "complete", "SELECT crypto_id, date, completeness_pct, missing FROM complete")
sql("price_anomalies", "odd", "SELECT * FROM odd")
sql("price_anomalies_orders", "", """SELECT p.crypto_id, count(*) FILTER (abs(x - m) > 3 * sd AND n >= 3) AS anomaly_count,
    round(count(*) FILTER (abs(x - m) > 3 * sd AND n >= 3) / count(*) * 100, 2) AS anomaly_pct
    FROM (SELECT CAST(o_custkey AS VARCHAR) AS crypto_id, o_totalprice AS x FROM orders) p
    JOIN (SELECT CAST(o_custkey AS VARCHAR) AS crypto_id, avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS sd, count(*) AS n
          FROM orders GROUP BY 1) s USING (crypto_id) GROUP BY 1""")
sql("observatory", "observed", """SELECT crypto_id, hours_since_update, is_fresh, completeness_pct, missing, anomaly_count, anomaly_pct,
    score FROM observed""")
sql("health_report", "observed", """SELECT crypto_id, score, CASE WHEN score >= 90 THEN 'A' WHEN score >= 75 THEN 'B' WHEN score >= 60 THEN 'C'
    WHEN score >= 45 THEN 'D' ELSE 'F' END AS grade, CASE WHEN score >= 75 THEN 'HEALTHY' WHEN score >= 50 THEN 'DEGRADED'
    ELSE 'CRITICAL' END AS status FROM (SELECT crypto_id, score FROM observed
    UNION ALL SELECT 'OVERALL', round(avg(score), 2) FROM observed)""")
ORACLE["health_recommendations"] = _with("observed").rstrip() + """,
problems AS (SELECT crypto_id, crypto_id || ': data is ' || format('{:.1f}', __H__)
        || 'h old — check ingestion pipeline' AS recommendation FROM observed WHERE NOT is_fresh
    UNION ALL SELECT crypto_id, crypto_id || ': ' || lacking || ' S3 paths missing — check data pipeline' FROM observed WHERE completeness_pct < 80
    UNION ALL SELECT crypto_id, crypto_id || ': ' || format('{:.1f}', __A__)
        || '% price anomalies — validate source data' FROM observed WHERE anomaly_pct >= 5)
SELECT * FROM problems UNION ALL SELECT NULL, 'All systems healthy — no action required' WHERE NOT EXISTS (SELECT 1 FROM problems)""".replace("__H__", half_up("hours_since_update", 1)).replace("__A__", half_up("anomaly_pct", 1))

# ---- correlation --------------------------------------------------------------------------------------------
sql("correlation_pairs", "pairs", "SELECT crypto1, crypto2, round(correlation, 6) AS correlation FROM pairs")
sql("correlation_pairs_returns", "returns", """SELECT a.crypto_id AS crypto1, b.crypto_id AS crypto2, round(corr(a.r, b.r), 6) AS correlation
    FROM returns a JOIN returns b ON a.date = b.date AND a.crypto_id < b.crypto_id GROUP BY 1, 2""")
sql("high_correlation", "pairs", "SELECT crypto1, crypto2, round(correlation, 4) AS correlation FROM pairs WHERE correlation > 0.05")
sql("correlation_extremes", "pairs", """SELECT arg_min(crypto1 || '/' || crypto2, correlation) AS lowest_pair, round(min(correlation), 6) AS lowest,
    arg_max(crypto1 || '/' || crypto2, correlation) AS highest_pair, round(max(correlation), 6) AS highest FROM pairs""")
sql("beta", "returns", """SELECT a.crypto_id, coalesce(round(CASE WHEN count(*) >= 2 AND var_samp(m.r) <> 0
    THEN covar_samp(a.r, m.r) / var_samp(m.r) END, 4), 0.0) AS beta
    FROM returns a JOIN returns m ON m.date = a.date AND m.crypto_id = 'click' WHERE a.crypto_id <> 'click' GROUP BY 1""")

# ---- indicators ------------------------------------------------------------------------------------------------
sql("sma", "framed", "SELECT crypto_id, event_timestamp, round(m, 6) AS sma FROM framed WHERE rn >= 20")
sql("bollinger", "framed", """SELECT crypto_id, event_timestamp, round(m + 2 * sd, 6) AS upper, round(m, 6) AS middle,
    round(m - 2 * sd, 6) AS lower FROM framed WHERE rn >= 20""")
sql("rsi", "strength", """SELECT crypto_id, event_timestamp, round(rsi, 4) AS rsi FROM strength JOIN numbered USING (crypto_id, rn)""")
_LONG = "crypto_id IN (SELECT crypto_id FROM numbered GROUP BY 1 HAVING count(*) >= 35)"
sql("macd", "averages", f"""SELECT crypto_id, event_timestamp, round(line, 6) AS macd, round(sig, 6) AS signal,
    round(line - sig, 6) AS histogram FROM averages JOIN numbered USING (crypto_id, rn) WHERE {_LONG}""")
sql("technical_analysis", "framed strength averages", f"""SELECT n.crypto_id, n.event_timestamp, n.price_usd,
    CASE WHEN n.rn >= 20 THEN round(m, 6) END AS sma, CASE WHEN n.rn >= 20 THEN round(m + 2 * sd, 6) END AS upper,
    CASE WHEN n.rn >= 20 THEN round(m, 6) END AS middle, CASE WHEN n.rn >= 20 THEN round(m - 2 * sd, 6) END AS lower,
    round(rsi, 4) AS rsi, round(line, 6) AS macd, round(sig, 6) AS signal, round(line - sig, 6) AS histogram
    FROM numbered n JOIN framed b USING (crypto_id, rn) LEFT JOIN strength s USING (crypto_id, rn)
    LEFT JOIN (SELECT * FROM averages WHERE {_LONG}) a USING (crypto_id, rn)""")

# ---- audit, storage, versions --------------------------------------------------------------------------------------
sql("audit_report", "entries", """SELECT 'action' AS kind, action AS key, count(*) AS entries FROM entries GROUP BY action
    UNION ALL SELECT 'resource', resource, count(*) FROM entries GROUP BY resource UNION ALL SELECT 'total', 'all', count(*) FROM entries""")
sql("storage_size", "objects", """SELECT prefix, round(sum(size) / 1048576.0::DOUBLE, 4) AS total_size_mb, count(*) AS object_count
    FROM objects GROUP BY 1""")
sql("cost_report", "objects", f"""SELECT total_objects, round(mb, 4) AS total_size_mb, archival_candidates,
    round(gb * 0.023::DOUBLE, 6) AS standard_cost, round(gb * 0.004::DOUBLE, 6) AS cold_cost,
    round(round(gb * 0.023::DOUBLE, 6) - round(gb * 0.004::DOUBLE, 6), 6) AS savings FROM (
    SELECT *, archival_candidates * (mb / total_objects) / 1024 AS gb FROM (
        SELECT sum(n)::BIGINT AS total_objects, sum(mb) AS mb, sum(c)::BIGINT AS archival_candidates FROM (
            SELECT prefix, count(*) AS n, round(sum(size) / 1048576.0::DOUBLE, 4) AS mb,
                count(*) FILTER (last_modified < {AS_OF} - INTERVAL 20 DAY) AS c FROM objects GROUP BY 1)))""")
sql("daily_counts", "alerts windows", """SELECT CAST(p.date AS VARCHAR) AS date, total_events, coalesce(total_alerts, 0) AS total_alerts,
    coalesce(total_aggregations, 0) AS total_aggregations FROM
    (SELECT CAST(event_timestamp AS DATE) AS date, count(*) AS total_events FROM prices GROUP BY 1) p
    LEFT JOIN (SELECT CAST(created_at AS DATE) AS date, count(*) AS total_alerts FROM alerts GROUP BY 1) a USING (date)
    LEFT JOIN (SELECT CAST(window_start AS DATE) AS date, count(*) AS total_aggregations FROM windows GROUP BY 1) w USING (date)""")
sql("version_ids", "snapshots", "SELECT crypto_id, date, version_id FROM snapshots")
sql("list_versions", "snapshots", """SELECT version_id, created_at FROM snapshots WHERE crypto_id = 'click' AND step = 'consume'
    AND date = '2024-01-15'""")
sql("version_counts", "snapshots", """SELECT count(*) AS total_versions, count(DISTINCT crypto_id) AS assets_with_versions FROM snapshots""")
_FIRST = "(SELECT crypto_id, step, date, arg_min(version_id, created_at) AS version_id FROM snapshots GROUP BY 1, 2, 3)"
sql("rollback", "snapshots", f"SELECT s.* FROM snapshots s JOIN {_FIRST} f USING (crypto_id, step, date, version_id)")
sql("rollback_preview", "snapshots", """SELECT s.crypto_id, s.step, s.date, arg_max(version_id, created_at) AS current_version,
    arg_min(version_id, created_at) AS target_version, count(*) FILTER (created_at > f.cut) AS versions_undone FROM snapshots s
    JOIN (SELECT crypto_id, step, date, min(created_at) AS cut FROM snapshots GROUP BY 1, 2, 3) f
    ON f.crypto_id = s.crypto_id AND f.step = s.step AND f.date = s.date GROUP BY 1, 2, 3""")
sql("map_events", "prices", f"""SELECT event_id, {half_up('price_usd / change_24h_pct', 6)} AS price_per_change,
    CAST(floor(price_usd) AS BIGINT) AS floor_price FROM prices WHERE change_24h_pct <> 0""")
