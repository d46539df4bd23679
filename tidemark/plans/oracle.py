"""The same results in DuckDB SQL over the given tables."""

from __future__ import annotations

_EV = """
ev AS (SELECT *, epoch_us(ts) // 1000000 AS sec,
              epoch_us(ts) // 1000000 // 1800 * 1800 AS bucket_ts FROM events)"""

_TXT = f"""{_EV},
txt AS (SELECT *, sec::varchar AS s, user_id::varchar AS u, event_id::varchar AS e FROM ev)"""

_LINES = f"""{_TXT},
lines AS (
  SELECT event_id, sec, bucket_ts, user_id,
    CASE event_id % 10
      WHEN 0 THEN concat_ws(chr(9), s, u, event_type)
      WHEN 1 THEN concat_ws(chr(9), s, u, event_type, props, e)
      WHEN 2 THEN concat(concat_ws(chr(9), s, u, event_type, props), chr(9), chr(9))
      WHEN 3 THEN concat_ws(chr(9), s, u, event_type, props, e, e)
      WHEN 4 THEN concat_ws(chr(9), s, u, event_type, '', e)
      WHEN 5 THEN concat(concat_ws(chr(9), s, u, event_type), chr(9))
      WHEN 6 THEN concat_ws(chr(9), s, u)
      ELSE concat_ws(chr(9), s, u, event_type, props) END AS line
  FROM txt),
rec AS (SELECT *, string_split(rtrim(line, chr(9)), chr(9)) AS f FROM lines),
kept AS (SELECT event_id, sec, bucket_ts, user_id, reverse(f[2]) || '-' || f[1] AS userid_ts,
                f[4] AS payload FROM rec WHERE len(f) IN (4, 5))"""

_PAYLOAD_ROWS = """
payloads AS (
  SELECT event_id, bucket_ts,
    CASE event_id % 12
      WHEN 0 THEN '{bad'
      WHEN 1 THEN ''
      WHEN 2 THEN concat('{"header":{"icid":"c', e, '"}}')
      WHEN 3 THEN concat('{"dimensions":{"mo":{"imsi":"', u, '"}}}')
      WHEN 4 THEN '[1]'
      WHEN 5 THEN CAST(NULL AS varchar)
      WHEN 6 THEN '{"header":null}'
      WHEN 7 THEN concat('{"header":{"icid":"c', e, '"}} junk')
      WHEN 8 THEN concat('{"header":{"icid":"c', e, '"}}}')
      WHEN 9 THEN concat('{"header":{"icid":"c', e, '"}} {"header":{"icid":"d"}}')
      WHEN 10 THEN concat('{"x":1,"x":[2],"header":{"icid":"c', e, '"}}')
      ELSE concat('{"header":{"icid":"c', e, '","start":', s,
                  '},"dimensions":{"mo":{"imsi":"', u, '"},"mt":{"imsi":""}}}') END AS p
  FROM txt)"""

_PAYLOADS = f"{_TXT},{_PAYLOAD_ROWS}"


def _keys(n: str) -> str:
    """Split key number ``i`` of ``n``."""
    d = f"(ceil(log10({n}))::int + CASE WHEN {n} % 10 = 0 THEN 0 ELSE 1 END)"
    share = f"(i::float / {n}::float)::double"
    return f"lpad(floor({share} * pow(10, {d}) + 0.5)::bigint::varchar, {d}, '0')"


def _bounds(n: int) -> str:
    return f"bounds AS (SELECT {_keys(str(n))} AS k FROM range(1, {n}) r(i))"


def _getter(path: str) -> str:
    return f"""CASE WHEN p IS NULL OR trim(p) IN ('', 'null') THEN ''
      WHEN NOT json_valid(p) THEN '_' WHEN json_type(p) <> 'OBJECT' THEN '_'
      ELSE coalesce(json_extract_string(p, '{path}'), '') END"""


_ICID, _START = _getter("$.header.icid"), _getter("$.header.start")
_MO, _MT = _getter("$.dimensions.mo.imsi"), _getter("$.dimensions.mt.imsi")

_READY = f"""{_EV},
ready AS (SELECT DISTINCT bucket_ts, '/in/ts=' || bucket_ts AS path FROM ev),
processed AS (SELECT * FROM ready WHERE bucket_ts % 86400 < 43200),
batches AS (SELECT *, (row_number() OVER (ORDER BY path) - 1) // 5 + 1 AS iteration FROM ready),
load_log AS (
  SELECT iteration, max(bucket_ts) + 1800 AS started,
         max(bucket_ts) + 1800 + sum(n)::bigint AS finished, count(*) AS n_buckets
  FROM batches JOIN (SELECT bucket_ts, count(*) AS n FROM ev GROUP BY 1) USING (bucket_ts)
  GROUP BY iteration),
times AS (SELECT *, (finished - started) // greatest(n_buckets, 1) AS load_time FROM load_log),
means AS (
  SELECT *, sum(load_time) OVER w // count(*) OVER w AS mean_load_time
  FROM times WINDOW w AS (ORDER BY iteration ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)),
summary AS (
  SELECT iteration, string_agg(path, ',' ORDER BY path) AS paths,
         string_agg(bucket_ts::varchar, ',' ORDER BY bucket_ts::varchar) AS epochs,
         max(bucket_ts) AS last_ts, max(path) AS last_path
  FROM batches GROUP BY iteration)"""

_TABLE = f"""{_LINES},
{_bounds(10)},
stored AS (
  SELECT sec // 86400 * 86400 AS bucket_ts,
         (SELECT count(*) FROM bounds WHERE k <= userid_ts)::int AS region,
         userid_ts, payload, user_id, sec FROM kept),
serving AS (
  SELECT userid_ts, payload, CAST(NULL AS varchar) AS location_history, user_id, sec FROM (
    SELECT *, row_number() OVER (PARTITION BY userid_ts ORDER BY bucket_ts DESC, payload DESC) AS rn
    FROM stored) WHERE rn = 1),
busiest AS (
  SELECT user_id AS uid, max(sec) AS last_sec FROM kept GROUP BY user_id
  ORDER BY count(*) DESC, user_id LIMIT 1)"""

_DATED = f"""WITH {_TABLE},
days AS (SELECT DISTINCT sec // 86400 * 86400 AS bucket_ts FROM ev),
places AS (
  SELECT bucket_ts, (row_number() OVER (
    ORDER BY CASE WHEN bucket_ts % 172800 = 0 THEN 'a' ELSE 'b' END, bucket_ts::varchar) - 1) // 10 + 1 AS load_number FROM days)"""
_STORED = f"WITH {_TABLE} SELECT bucket_ts, region, userid_ts, payload FROM stored"
_SERVED = f"WITH {_TABLE} SELECT userid_ts, payload, location_history FROM serving"

ORACLE_SQL: dict[str, str] = {
    "split_fields": f"""WITH {_LINES}
        SELECT event_id, len(f)::int AS n_fields, array_to_string(f, '|') AS fields FROM rec""",
    "filter_arity_4_5": f"""WITH {_LINES}
        SELECT event_id, len(f)::int AS n_fields FROM rec WHERE len(f) IN (4, 5)""",
    "filter_arity_2_4": f"""WITH {_LINES}
        SELECT event_id, len(f)::int AS n_fields FROM rec WHERE len(f) IN (2, 4)""",
    "rowkey_build": f"WITH {_LINES} SELECT event_id, userid_ts, payload FROM kept",
    "cell_encode": f"""WITH {_LINES}
        SELECT hex(encode(userid_ts)) AS row_hex, hex(encode('data')) AS family_hex,
               hex(encode('payload')) AS qualifier_hex, hex(encode(payload)) AS value_hex
        FROM kept""",
    "filter_key_length": """
        SELECT doc_id, octet_length(encode(text || '-' || doc_id)) AS key_bytes
        FROM documents WHERE octet_length(encode(text || '-' || doc_id)) <= 32767""",
    "split_keys": f"""
        SELECT n AS regions, i::int AS region, {_keys('n')} AS split_key
        FROM (SELECT DISTINCT p_size AS n FROM part) parts, LATERAL (SELECT unnest(range(1, n)) AS i)""",
    "region_bounds": """
        WITH regions AS (
          SELECT CASE WHEN c_nationkey = 0 THEN ''
                      ELSE left(reverse(c_custkey::varchar), 2) END AS start_key,
                 c_mktsegment = 'BUILDING' AS is_split FROM customer),
        live AS (SELECT DISTINCT start_key FROM regions WHERE NOT is_split AND start_key <> '')
        SELECT row_number() OVER (ORDER BY start_key)::int AS region, start_key FROM live""",
    "region_lookup": f"""WITH {_EV}, {_bounds(100)},
        keys AS (SELECT event_id, reverse(user_id::varchar) || '-' || sec AS userid_ts FROM ev)
        SELECT event_id, userid_ts,
               (SELECT count(*) FROM bounds WHERE k <= userid_ts)::int AS region FROM keys""",
    "region_histogram": f"""WITH {_EV}, {_bounds(100)},
        keys AS (SELECT reverse(user_id::varchar) || '-' || sec AS userid_ts FROM ev)
        SELECT region, count(*) AS n_rows FROM (
          SELECT (SELECT count(*) FROM bounds WHERE k <= userid_ts)::int AS region FROM keys)
        GROUP BY region""",
    "range_layout": f"""WITH {_LINES}, {_bounds(100)},
        placed AS (SELECT (SELECT count(*) FROM bounds WHERE k <= userid_ts)::int AS region,
                          userid_ts, payload FROM kept)
        SELECT region, userid_ts, payload,
               row_number() OVER (PARTITION BY region ORDER BY userid_ts, payload) AS position
        FROM placed""",
    "multi_bucket_scan": f"WITH {_LINES} SELECT sec // 86400 * 86400 AS bucket_ts, line FROM lines",
    "bucket_discovery": f"""WITH {_EV}
        SELECT sec // 86400 * 86400 AS bucket_ts, count(*) AS n_lines FROM ev GROUP BY 1""",
    "ready_listing": f"""WITH {_EV}
        SELECT DISTINCT sec // 86400 * 86400 AS bucket_ts, '/in/ts=' || (sec // 86400 * 86400) AS path
        FROM ev""",
    "ready_minus_processed": f"""WITH {_READY}
        SELECT bucket_ts, path FROM ready r
        WHERE NOT EXISTS (SELECT 1 FROM processed p WHERE p.bucket_ts = r.bucket_ts)""",
    "bucket_batches": f"""WITH {_READY},
        waiting AS (SELECT * FROM ready r
                    WHERE NOT EXISTS (SELECT 1 FROM processed p WHERE p.bucket_ts = r.bucket_ts))
        SELECT bucket_ts, path, (row_number() OVER (ORDER BY path) - 1) // 5 AS batch_id
        FROM waiting""",
    "processed_ledger": f"""WITH {_READY}
        SELECT bucket_ts, path, CASE WHEN bucket_ts % 86400 < 43200 THEN 1 ELSE 2 END::bigint AS batch_id
        FROM ready""",
    "json_icid": f"WITH {_PAYLOADS} SELECT event_id, {_ICID} AS icid FROM payloads",
    "json_start": f"WITH {_PAYLOADS} SELECT event_id, {_START} AS start FROM payloads",
    "json_mo_imsi": f"WITH {_PAYLOADS} SELECT event_id, {_MO} AS mo_imsi FROM payloads",
    "json_mt_imsi": f"WITH {_PAYLOADS} SELECT event_id, {_MT} AS mt_imsi FROM payloads",
    "filter_mo_present": f"""WITH {_PAYLOADS}
        SELECT * FROM (SELECT event_id, {_MO} AS mo_imsi FROM payloads) WHERE mo_imsi <> ''""",
    "filter_mt_present": f"""WITH {_PAYLOADS}
        SELECT * FROM (SELECT event_id, {_MT} AS mt_imsi FROM payloads) WHERE mt_imsi <> ''""",
    "filter_json_valid": f"""WITH {_PAYLOADS}
        SELECT event_id, p AS payload FROM payloads WHERE coalesce(json_valid(p), false)""",
    "quality_counters": f"""WITH {_LINES},
        {_PAYLOAD_ROWS},
        arity AS (
          SELECT bucket_ts, count(*) AS n_split, count(*) FILTER (WHERE len(f) NOT IN (4, 5)) AS split_drop
          FROM rec GROUP BY bucket_ts),
        imsi AS (
          SELECT bucket_ts, count(*) AS n_mo_imsi, count(*) FILTER (WHERE {_MO} = '') AS mo_imsi_drop,
                 count(*) AS n_mt_imsi, count(*) FILTER (WHERE {_MT} = '') AS mt_imsi_drop
          FROM payloads GROUP BY bucket_ts)
        SELECT bucket_ts, n_split, split_drop, n_mo_imsi, mo_imsi_drop, n_mt_imsi, mt_imsi_drop
        FROM arity JOIN imsi USING (bucket_ts)""",
    "ledger_counts": f"""WITH {_READY}
        SELECT 'ZnodesInReady' AS name, count(*) AS entries FROM ready
        UNION ALL SELECT 'ZnodesInProcessed', count(*) FROM processed""",
    "buckets_ahead": f"""WITH {_READY}
        SELECT bucket_ts, count(*) OVER (
          ORDER BY bucket_ts RANGE BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS ahead FROM ready""",
    "load_time": f"WITH {_READY} SELECT iteration, load_time FROM times",
    "trailing_load_mean": f"WITH {_READY} SELECT iteration, mean_load_time::bigint AS mean_load_time FROM means",
    "bucket_lag": f"""WITH {_READY}
        SELECT bucket_ts, started - bucket_ts AS "DelayOverallHBaseLoad",
               started - bucket_ts AS "DelayBulkLoader"
        FROM batches JOIN load_log USING (iteration)""",
    "last_batch_summary": f"""WITH {_READY}
        SELECT iteration, paths AS "lastProcessedPath", epochs AS "lastProcessedTS" FROM summary""",
    "metrics_latest": f"""WITH {_READY},
        all_loads AS (SELECT * FROM means JOIN summary USING (iteration)),
        written AS (
          SELECT 'AvgBucketProcessTime' AS name, mean_load_time::bigint::varchar AS value, started AS updated_at FROM all_loads
          UNION ALL SELECT 'CurrentProcessPath', last_path, started FROM all_loads
          UNION ALL SELECT 'CurrentProcessTS', last_ts::varchar, started FROM all_loads
          UNION ALL SELECT 'DelayOverallHBaseLoad', (started - last_ts)::varchar, started FROM all_loads
          UNION ALL SELECT 'DelayBulkLoader', (started - last_ts)::varchar, started FROM all_loads
          UNION ALL SELECT 'lastProcessedPath', paths, finished FROM all_loads
          UNION ALL SELECT 'lastProcessedTS', epochs, finished FROM all_loads
          UNION ALL SELECT 'lastProcessTime', load_time::varchar, finished FROM all_loads
          UNION ALL SELECT 'NumberOfUnprocessedBucketsAhead',
                           (SELECT count(*) FROM ready WHERE bucket_ts > last_ts)::varchar, started FROM all_loads
          UNION ALL SELECT 'ZnodesInReady', (SELECT count(*) FROM ready)::varchar, finished FROM all_loads
          UNION ALL SELECT 'ZnodesInProcessed',
                           (SELECT count(*) FROM batches b WHERE b.iteration <= all_loads.iteration)::varchar, finished FROM all_loads
          UNION ALL SELECT 'CellLocLastUpdate', min(started)::varchar, min(started) FROM all_loads GROUP BY started // 604800
          UNION ALL SELECT 'ApplicationID', 'loader', min(started) FROM all_loads)
        SELECT name, value, updated_at FROM (
          SELECT *, row_number() OVER (PARTITION BY name ORDER BY updated_at DESC, value DESC) AS rn
          FROM written WHERE value IS NOT NULL) WHERE rn = 1""",
    "upsert_keep_last": f"""WITH {_EV},
        versions AS (SELECT reverse(user_id::varchar) || '-' || (sec // 86400 * 86400) AS userid_ts,
                            bucket_ts, props AS payload FROM ev)
        SELECT userid_ts, bucket_ts, payload FROM (
          SELECT *, row_number() OVER (PARTITION BY userid_ts ORDER BY bucket_ts DESC, payload DESC) AS rn
          FROM versions) WHERE rn = 1""",
    "retention_ttl": f"""WITH {_EV}
        SELECT event_id, bucket_ts FROM ev
        WHERE bucket_ts + 2592000 >= epoch_us(TIMESTAMP '2024-02-10 00:00:00') // 1000000""",
    "bulk_load": _STORED,
    "serving_view": _SERVED,
    "point_get": f"{_SERVED} JOIN busiest ON user_id = uid AND sec = last_sec",
    "user_scan": f"{_SERVED} JOIN busiest ON user_id = uid",
    "sql_user_read": f"{_SERVED} JOIN busiest ON user_id = uid",
    "merged_view": _SERVED,
    "retention_stored": f"""{_DATED}
        SELECT userid_ts, payload FROM serving JOIN places ON bucket_ts = sec // 86400 * 86400 WHERE load_number > 1""",
    "location_refreshes": f"""{_DATED}
        SELECT bucket_ts, userid_ts, n_name || '-' || load_number AS location_history
        FROM stored JOIN places USING (bucket_ts) LEFT JOIN customer ON user_id = c_custkey
        LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "user_time_range": f"""{_SERVED} JOIN busiest ON user_id = uid
        WHERE sec >= 1704844800 AND sec < 1705708800""",
    "location_enrich": """
        SELECT event_id, user_id, n_regionkey AS mcc, n_nationkey AS mnc, n_name AS location_history
        FROM events LEFT JOIN customer ON user_id = c_custkey
        LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "location_refresh_due": f"""WITH {_READY}
        SELECT iteration, min(started) OVER w AS last_refresh,
               started - min(started) OVER w > 24 * 3600 AS due
        FROM load_log WINDOW w AS (PARTITION BY started // 604800)""",
    "stream_load": _STORED,
    "late_bucket": _STORED,
}
