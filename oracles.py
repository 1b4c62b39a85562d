"""DuckDB SQL giving the same rows as each query, over the same tables."""

from __future__ import annotations

RAW_PLAYS = """
raw_plays AS (
  SELECT event_id AS play_id, user_id,
    CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS video_id,
    CAST(regexp_extract(props, '[0-9]+') AS BIGINT) // 10 AS channel_id,
    value AS minutes_played, ts AS "timestamp",
    CASE event_type WHEN 'click' THEN 'true' WHEN 'view' THEN '' WHEN 'signup' THEN 'false' END AS liked,
    CASE event_type WHEN 'error' THEN 'true' WHEN 'purchase' THEN ' ' END AS disliked,
    CASE WHEN event_type = 'purchase' OR (event_type = 'click' AND event_id % 3 = 0)
      THEN 1 ELSE 0 END AS video_end_type,
    CASE WHEN event_type <> 'signup'
      THEN 'G' || (CAST(regexp_extract(props, '[0-9]+') AS BIGINT) // 10) END AS geo_cd,
    CASE WHEN event_type <> 'error'
      THEN CAST(regexp_extract(props, '[0-9]+') AS BIGINT) % 25 END AS creator_id
  FROM events)"""

PLAYS = RAW_PLAYS + """,
plays AS (SELECT * REPLACE (coalesce(liked = 'true', false) AS liked) FROM raw_plays)"""

CLEAN = RAW_PLAYS + """,
channel_geocd AS (
  SELECT CAST(n_nationkey AS BIGINT) AS channel_id, 'G' || n_nationkey AS geo_cd
  FROM nation WHERE n_regionkey > 0),
video_creator AS (
  SELECT p_partkey AS video_id, p_partkey % 25 AS creator_id FROM part WHERE p_size <= 40),
enriched AS (
  SELECT p.play_id, coalesce(p.geo_cd, g.geo_cd) AS geo_cd,
    coalesce(p.creator_id, c.creator_id) AS creator_id,
    coalesce(p.liked = 'true', false) AS liked, coalesce(p.disliked = 'true', false) AS disliked
  FROM raw_plays p LEFT JOIN channel_geocd g ON p.channel_id = g.channel_id
  LEFT JOIN video_creator c ON p.video_id = c.video_id)"""

SUBSCRIBED = PLAYS + """,
subs AS (
  SELECT c_custkey AS user_id,
    CASE WHEN c_acctbal < 0 THEN TIMESTAMP '2024-01-15' ELSE TIMESTAMP '2024-12-31' END AS ends
  FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'),
typed AS (
  SELECT p.*, CASE WHEN s.ends >= p."timestamp" THEN 'subscribed' ELSE 'unsubscribed' END AS user_type
  FROM plays p LEFT JOIN subs s ON p.user_id = s.user_id)"""

MINUTES = "CAST(sum(CAST(minutes_played AS DECIMAL(18,2))) AS DOUBLE) AS duration"

STOPS = """
stops AS (
  SELECT l_suppkey AS StopID, s_name AS StopName, round(l_discount * 100) AS MilesAway,
    l_quantity AS NumberOfBoardings
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
top_stops AS (
  SELECT StopID, StopName, count(*) AS count_stop_id FROM stops WHERE MilesAway < 3
  GROUP BY StopID, StopName ORDER BY count_stop_id DESC, StopID, StopName LIMIT 20)"""

WORDS = """
words AS (
  SELECT unnest(string_split_regex(lower(text), '[ \\t\\n\\r\\f]+')) AS word FROM documents),
counted AS (SELECT word, count(*) AS n FROM words WHERE word <> '' GROUP BY word)"""

GEO = """
geo AS (
  SELECT n_nationkey * 5 - 60.0 AS latitude, n_nationkey * 14 - 170.0 AS longitude,
    s_suppkey AS merchant_id
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""

TXNS = """
txns AS (
  SELECT o_orderkey AS txn_id, o_custkey AS card_id, o_custkey AS user_id,
    o_orderkey % (SELECT count(*) FROM supplier) AS merchant_id, o_totalprice AS amount,
    o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS INTEGER)) AS ts
  FROM orders)"""

LAST = TXNS + "," + GEO + """,
located AS (
  SELECT t.*, CAST(g.latitude AS DOUBLE) AS latitude, CAST(g.longitude AS DOUBLE) AS longitude
  FROM txns t LEFT JOIN geo g ON t.merchant_id = g.merchant_id),
last_txn AS (
  SELECT *, lag(txn_id) OVER w AS last_txn_id, lag(ts) OVER w AS last_ts,
    lag(merchant_id) OVER w AS last_merchant_id, lag(latitude) OVER w AS last_latitude,
    lag(longitude) OVER w AS last_longitude
  FROM located WINDOW w AS (PARTITION BY card_id ORDER BY ts, txn_id)),
travelled AS (
  SELECT *, CASE WHEN latitude = last_latitude AND longitude = last_longitude THEN 0.0
      WHEN latitude IS NOT NULL AND longitude IS NOT NULL
        AND last_latitude IS NOT NULL AND last_longitude IS NOT NULL
      THEN 6371 * acos(greatest(-1.0, least(1.0,
        sin(radians(last_latitude)) * sin(radians(latitude))
        + cos(radians(last_latitude)) * cos(radians(latitude))
          * cos(radians(longitude) - radians(last_longitude))))) END AS distance,
    (epoch_us(ts) - epoch_us(last_ts)) / 1e6 / 60 AS minutes
  FROM last_txn),
timed AS (
  SELECT *, CASE WHEN minutes = 0 AND distance = 0 THEN 0.0
      WHEN minutes = 0 AND distance > 0 THEN CAST('inf' AS DOUBLE)
      ELSE distance / minutes END AS speed
  FROM travelled)"""


def _limits(source: str) -> str:
    return f"""
limited AS (
  SELECT *, 2 * (stddev_samp(amount) OVER w + avg(amount) OVER w) AS utl,
    5 * (stddev_samp(amount) OVER w + avg(amount) OVER w) AS ctl
  FROM {source}
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, txn_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING))"""


DECIDED = LAST + "," + _limits("timed") + """,
decided AS (
  SELECT l.*, c_acctbal AS credit_score,
    CASE WHEN coalesce(speed > 13, false) OR coalesce(c_acctbal < 250, false)
        OR coalesce(amount > ctl, false) THEN 'Suspicious'
      WHEN coalesce(amount > utl, false) THEN 'Approval Pending' ELSE 'Approved' END AS status
  FROM limited l LEFT JOIN customer ON user_id = c_custkey)"""

STATUS = "CASE WHEN event_type = 'error' THEN 500 WHEN event_id % 13 = 0 THEN 404 ELSE 200 END"
METHOD = "CASE event_type WHEN 'purchase' THEN 'POST' ELSE 'GET' END"
REFERER = """CASE event_type WHEN 'click' THEN '"http://shop/a b"' ELSE '-' END"""

WEBLOG = f"""
weblog AS (
  SELECT event_id, CASE WHEN event_type = 'signup' THEN 'signup ' || event_id || ' ' || props
    ELSE '10.0.0.' || user_id || ' - - [' || CASE WHEN event_id % 17 = 0 THEN '31/Feb/2024:10:00:00'
        ELSE strftime(ts, '%d/%b/%Y:%H:%M:%S') END || ' +0000] "' || {METHOD} || ' /'
      || CASE event_type WHEN 'view' THEN 'digital-cameras' WHEN 'click' THEN 'Digital-Cameras'
           ELSE event_type END
      || '/item-' || event_id || ' HTTP/1.1" ' || {STATUS} || ' '
      || CAST(floor(value * 100) AS BIGINT) || ' ' || {REFERER} || ' agent/' || props END AS value
  FROM events)"""

REJECTED = f"""WITH {WEBLOG}
SELECT value AS record,
  CASE WHEN value LIKE 'signup %' THEN 'malformed' ELSE 'impossible time' END AS reject_reason
FROM weblog WHERE value LIKE 'signup %' OR value LIKE '%[31/Feb/%'"""

PARSED = f"""
parsed AS (
  SELECT '10.0.0.' || user_id AS ip, date_trunc('second', ts) AS ts, {METHOD} AS method,
    CASE event_type WHEN 'view' THEN 'digital-cameras' WHEN 'click' THEN 'Digital-Cameras'
      ELSE event_type END || '/item-' || event_id AS path,
    {STATUS} AS status, CAST(floor(value * 100) AS BIGINT) AS bytes, {REFERER} AS referer,
    'agent/' || props AS agent, event_type IN ('view', 'click') AS camera
  FROM events WHERE event_type <> 'signup' AND event_id % 17 <> 0)"""

FIVE_MINUTES = "time_bucket(INTERVAL '5 minutes', ts)"

STATUS_WINDOWS = PARSED + f""",
status_windows AS (
  SELECT {FIVE_MINUTES} AS window_start, count(*) FILTER (status <> 200) AS failures,
    count(*) FILTER (status = 200) AS successes, count(*) FILTER (camera) AS category_hits
  FROM parsed GROUP BY 1)"""

RATE_ALERTS = f"""WITH {PARSED}
SELECT ts AS window_start, 'n_requests > 1' AS alert, count(*) AS observed
FROM parsed GROUP BY ts HAVING count(*) > 1"""

# Merchants with no fewer suspicious transactions than the average merchant.
STRICT = f"""{DECIDED},
struck AS (SELECT merchant_id, count(*) AS strikes FROM decided WHERE status = 'Suspicious'
  GROUP BY merchant_id)
SELECT merchant_id, strikes FROM struck
WHERE strikes >= (SELECT CAST(ceil(avg(strikes)) AS BIGINT) FROM struck)"""

ORACLES = {
    "transit_top_stops": f"WITH {STOPS} SELECT * FROM top_stops",
    "transit_max_boardings": f"""WITH {STOPS}
SELECT t.StopName, max(s.NumberOfBoardings) AS max_boardings
FROM stops s JOIN top_stops t ON s.StopID = t.StopID GROUP BY t.StopName""",
    "word_count": f"WITH {WORDS} SELECT * FROM counted",
    "rare_words": f"WITH {WORDS} SELECT * FROM counted WHERE n < 100",
    "max_salary": """SELECT emp, max_salary, dept FROM (
  SELECT c_nationkey AS emp, c_acctbal AS max_salary, c_custkey AS dept,
    row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey DESC) AS rn
  FROM customer) WHERE rn = 1""",
    "dq_empty_to_null": f"""WITH {RAW_PLAYS}
SELECT play_id, nullif(trim(liked), '') AS liked, nullif(trim(disliked), '') AS disliked
FROM raw_plays""",
    "dq_fill_default": f"""WITH {RAW_PLAYS}
SELECT play_id, coalesce(nullif(trim(liked), ''), '0') AS liked,
  coalesce(nullif(trim(disliked), ''), '0') AS disliked, '0' AS shared
FROM raw_plays""",
    "dq_fill_strings": f"""WITH {RAW_PLAYS}
SELECT play_id, coalesce(liked, '') AS liked, coalesce(disliked, '') AS disliked,
  coalesce(geo_cd, '') AS geo_cd
FROM raw_plays""",
    "dq_enrich": f"""WITH {CLEAN}
SELECT * FROM enriched WHERE geo_cd IS NOT NULL AND creator_id IS NOT NULL""",
    "dq_rejects": f"""WITH {CLEAN}
SELECT play_id, concat_ws(',', CASE WHEN geo_cd IS NULL THEN 'missing geo_cd' END,
  CASE WHEN creator_id IS NULL THEN 'missing creator_id' END) AS reject_reason
FROM enriched WHERE geo_cd IS NULL OR creator_id IS NULL""",
    "dq_type_check": """SELECT event_id, user_id, date_trunc('second', ts) AS ts
FROM events WHERE event_type NOT IN ('error', 'signup')""",
    "dq_type_rejects": """SELECT event_id,
  CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(user_id AS VARCHAR) END AS user_id,
  CASE WHEN event_type = 'signup' THEN strftime(ts, '%Y-%m-%d')
    ELSE strftime(ts, '%d/%m/%Y %H:%M:%S') END AS ts,
  CASE WHEN event_type = 'error' THEN 'bad user_id' ELSE 'bad ts' END AS reject_reason
FROM events WHERE event_type IN ('error', 'signup')""",
    "dq_file_report": """SELECT event_type, count(*) AS n_rows, true AS name_ok
FROM events GROUP BY event_type""",
    "dq_distinct": f"WITH {RAW_PLAYS} SELECT DISTINCT user_id, video_id, liked FROM raw_plays",
    "set_except": f"""WITH {RAW_PLAYS}
SELECT user_id, video_id, liked FROM raw_plays
EXCEPT SELECT user_id, video_id, liked FROM raw_plays WHERE liked = 'true'""",
    "set_union": f"""WITH {RAW_PLAYS}
SELECT user_id, video_id, liked FROM raw_plays WHERE liked = 'true'
UNION ALL SELECT user_id, video_id, liked FROM raw_plays WHERE liked = 'false'""",
    "video_popular_channels": f"""WITH {PLAYS}
SELECT channel_id, count(DISTINCT video_id) AS count_video,
  count(DISTINCT CASE WHEN liked THEN user_id END) AS unique_likers,
  max(minutes_played) AS max_video_played
FROM plays GROUP BY channel_id""",
    "video_duration_by_user_type": f"""WITH {SUBSCRIBED}
SELECT user_type, {MINUTES} FROM typed GROUP BY user_type""",
    "video_connected_creators": f"""WITH {RAW_PLAYS}
SELECT c_nationkey AS creator_id, count(DISTINCT user_id) AS count_user
FROM raw_plays JOIN customer ON user_id = c_custkey GROUP BY c_nationkey""",
    "video_royalty": f"""WITH {PLAYS}
SELECT video_id, {MINUTES} FROM plays WHERE liked OR video_end_type = 1 GROUP BY video_id""",
    "video_royalty_both": f"""WITH {PLAYS}
SELECT video_id, {MINUTES} FROM plays WHERE liked AND video_end_type = 1 GROUP BY video_id""",
    "video_creator_royalty": f"""WITH {PLAYS}
SELECT creator_id, {MINUTES} FROM plays WHERE liked OR video_end_type = 1 GROUP BY creator_id""",
    "video_longest_unsubscribed": f"""WITH {SUBSCRIBED}
SELECT user_id, {MINUTES} FROM typed WHERE user_type = 'unsubscribed'
GROUP BY user_id ORDER BY duration DESC, user_id LIMIT 10""",
    "fraud_merchant_geo": f"""WITH {GEO}
SELECT CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, merchant_id
FROM geo""",
    "fraud_last_transaction": f"""WITH {LAST}
SELECT txn_id, card_id, ts, merchant_id, latitude, longitude, last_txn_id, last_ts,
  last_merchant_id, last_latitude, last_longitude
FROM last_txn""",
    "fraud_distance_over_time": f"""WITH {LAST}
SELECT txn_id, card_id, ts, round(distance, 3) AS distance, round(minutes, 3) AS minutes,
  round(speed, 3) AS speed
FROM timed""",
    "fraud_low_score": f"""WITH {TXNS}
SELECT txn_id, user_id, c_acctbal AS credit_score
FROM txns JOIN customer ON user_id = c_custkey WHERE c_acctbal < 250""",
    "fraud_amount_limits": f"""WITH {TXNS},{_limits("txns")}
SELECT txn_id, user_id, amount, round(utl, 4) AS utl, round(ctl, 4) AS ctl FROM limited""",
    "fraud_decision": f"""WITH {DECIDED}
SELECT txn_id, card_id, user_id, merchant_id, amount, ts, round(speed, 3) AS speed, credit_score,
  round(utl, 4) AS utl, round(ctl, 4) AS ctl, status
FROM decided""",
    "fraud_pos_blacklist": f"""WITH {DECIDED}
SELECT merchant_id, count(*) AS strikes FROM decided WHERE status = 'Suspicious'
GROUP BY merchant_id HAVING count(*) >= 3""",
    "fraud_pos_blacklist_strict": f"""WITH {STRICT}""",
    "fraud_lost_cards": f"""WITH {DECIDED}
SELECT card_id, ts AS lost_date FROM (
  SELECT card_id, ts, row_number() OVER (PARTITION BY card_id ORDER BY ts, txn_id) AS strike
  FROM decided WHERE status = 'Suspicious') WHERE strike = 3""",
    "fraud_blacklist_cards": f"""WITH {TXNS}
SELECT txn_id, card_id, amount FROM txns
WHERE card_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
    "fraud_blacklist_merchants": f"""WITH {TXNS}
SELECT txn_id, merchant_id, amount FROM txns
WHERE merchant_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)""",
    "click_parse": f"""WITH {PARSED}
SELECT ip, ts, method, path, status, bytes, referer, agent FROM parsed""",
    "click_rejects": REJECTED,
    "click_category": f"""WITH {PARSED}
SELECT {FIVE_MINUTES} AS window_start, count(*) AS category_hits FROM parsed WHERE camera
GROUP BY 1""",
    "click_request_rate": f"""WITH {PARSED}
SELECT ts AS window_start, count(*) AS n_requests FROM parsed GROUP BY ts""",
    "click_request_rate_by_ip": f"""WITH {PARSED}
SELECT date_trunc('hour', ts) AS window_start, ip, count(*) AS n_requests
FROM parsed GROUP BY 1, 2""",
    "click_status_windows": f"WITH {STATUS_WINDOWS} SELECT * FROM status_windows",
    "click_alerts": RATE_ALERTS,
    "click_failure_alerts": f"""WITH {STATUS_WINDOWS}
SELECT window_start, 'failures > 3' AS alert, failures AS observed
FROM status_windows WHERE failures > 3""",
    "stream_land_raw": f"WITH {WEBLOG} SELECT value FROM weblog",
    "stream_status_windows": f"WITH {STATUS_WINDOWS} SELECT * FROM status_windows",
    "stream_rate_alerts": RATE_ALERTS,
    "stream_rejects": REJECTED,
    "stream_blacklist_hits": f"""WITH {TXNS}
SELECT txn_id, card_id, merchant_id, amount, 'card_id' AS matched_on FROM txns
WHERE card_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
UNION ALL
SELECT txn_id, card_id, merchant_id, amount, 'merchant_id' AS matched_on FROM txns
WHERE merchant_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)""",
    "stream_fraud_decision": f"""WITH {DECIDED}
SELECT txn_id, card_id, amount, round(speed, 3) AS speed, status FROM decided""",
    "stream_late": f"""WITH {TXNS}
SELECT txn_id, card_id, amount FROM txns t WHERE EXISTS (
  SELECT 1 FROM txns e WHERE e.card_id = t.card_id AND e.txn_id % 4 < t.txn_id % 4
    AND (e.ts, e.txn_id) >= (t.ts, t.txn_id))""",
    "stream_pos_strikes": f"""WITH {DECIDED}
SELECT merchant_id, count(*) AS strikes FROM decided WHERE status = 'Suspicious'
GROUP BY merchant_id HAVING count(*) >= 3""",
    "stream_blacklist_loop": f"""WITH {DECIDED},
struck AS (SELECT merchant_id, txn_id % 4 AS turn FROM decided WHERE status = 'Suspicious')
SELECT txn_id, merchant_id, amount FROM decided d WHERE (
  SELECT count(*) FROM struck s WHERE s.merchant_id = d.merchant_id AND s.turn < d.txn_id % 4) >= 3""",
}
ORACLES["stream_lost_cards"] = ORACLES["fraud_lost_cards"]
ORACLES["fraud_from_files"] = f"""WITH {DECIDED}
SELECT txn_id::VARCHAR AS record, status FROM decided
UNION ALL SELECT 'x' || txn_id, 'malformed' FROM decided WHERE txn_id % 97 = 0"""
# Estimates are to be close for every channel.
ORACLES["video_popular_channels_sketched"] = f"""WITH {PLAYS}
SELECT channel_id, max(minutes_played) AS max_video_played, true AS video_close, true AS likers_close
FROM plays GROUP BY channel_id"""

ORACLES["dq_empty_files"] = """SELECT o_orderstatus AS status, false AS all_empty,
  sum(length(o_orderkey || ',' || o_orderpriority) + 1)::BIGINT AS n_bytes FROM orders GROUP BY 1
UNION ALL SELECT 'none', true, 0"""
INGESTED = """SELECT event_id, CASE WHEN event_id % 97 <> 0 THEN user_id END AS user_id,
  CASE WHEN event_id % 97 <> 0 THEN floor(value * 100)::BIGINT END AS cents,
  CASE WHEN event_id % 97 <> 0 THEN date_trunc('second', ts) END AS at,
  CASE WHEN event_id % 97 = 0 THEN 'malformed' END AS reject_reason FROM events"""
ORACLES["ingest_csv_glob"] = ORACLES["ingest_xml"] = INGESTED
ORACLES["ingest_csv_inferred"] = """SELECT event_id, floor(value * 100)::BIGINT AS cents,
  CASE WHEN event_id % 97 = 0 THEN 'n/a' ELSE user_id::VARCHAR END AS user_id, event_type AS kind,
  'long,string,long,string' AS types FROM events"""
ORACLES["ingest_tsv"] = "SELECT c_custkey, 'Grüße, ' || c_name AS name, c_mktsegment FROM customer"
ORACLES["ingest_stops"] = ORACLES["transit_top_stops"]
ORACLES["ingest_words"] = ORACLES["rare_words"]
ORACLES["ingest_employees"] = """SELECT emp, max_salary, dept, NULL AS record FROM (
  SELECT c_nationkey AS emp, floor(c_acctbal)::INTEGER AS max_salary, c_custkey::INTEGER AS dept,
    row_number() OVER (PARTITION BY c_nationkey ORDER BY floor(c_acctbal) DESC, c_custkey DESC) AS rn
  FROM customer WHERE c_custkey % 50 <> 0) WHERE rn = 1
UNION ALL SELECT NULL, NULL, NULL, 'short,' || c_custkey FROM customer WHERE c_custkey % 50 = 0"""

ORACLES["fraud_blacklist_prefiltered"] = ORACLES["fraud_blacklist_cards"]
ORACLES["click_heavy_clients"] = ORACLES["stream_heavy_clients"] = f"""WITH {PARSED}
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, ip, count(*) AS n_requests
FROM parsed GROUP BY 1, 2 HAVING count(*) > 3"""
