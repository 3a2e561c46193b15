"""Reference SQL (DuckDB dialect) for every key that has a relational equivalent.

The driver registers only the base tables, so each statement inlines the ``raw``,
``parsed`` and ``clean`` CTEs.  Column names and types follow the Spark outputs.
"""

from __future__ import annotations

RAW = """raw AS (
 SELECT event_id AS seq,
  CAST(CASE WHEN event_id % 50 = 49 THEN event_id - 1 ELSE event_id END AS VARCHAR) AS unique_key,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE 'AG' || CAST(user_id % 7 AS VARCHAR) END AS agency,
  event_type || '-' || CAST(user_id % 4 AS VARCHAR) AS complaint_type,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE props END AS descriptor,
  CASE WHEN event_id % 17 = 0 THEN NULL WHEN user_id % 3 = 0 THEN 'PHONE' WHEN user_id % 3 = 1 THEN 'ONLINE' ELSE 'MOBILE' END AS open_data_channel_type,
  CASE WHEN event_id % 17 <> 0 THEN NULL WHEN user_id % 3 = 0 THEN 'PHONE' WHEN user_id % 3 = 1 THEN 'ONLINE' ELSE 'MOBILE' END AS channel_type,
  CASE WHEN event_id % 2 = 0 THEN 'Closed' ELSE 'OPEN' END AS status,
  CASE user_id % 5 WHEN 0 THEN 'Bronx' WHEN 1 THEN 'BROOKLYN' WHEN 2 THEN 'manhattan' WHEN 3 THEN 'Queens' ELSE 'Staten Island' END AS borough,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(10000 + user_id AS VARCHAR) END AS incident_zip,
  CASE event_id % 13 WHEN 0 THEN 'N/A' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE '40.' || CAST(100 + event_id % 900 AS VARCHAR) END AS latitude,
  CASE event_id % 13 WHEN 3 THEN 'N/A' WHEN 4 THEN '' WHEN 5 THEN NULL ELSE '-73.' || CAST(100 + event_id % 900 AS VARCHAR) END AS longitude,
  CASE WHEN event_id % 101 = 0 THEN 'invalid-date-format'
       WHEN event_id % 10 = 0 THEN strftime(ts, '%m/%d/%Y %I:%M:%S %p')
       ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') END AS created_date
 FROM events)"""

PARSED = """parsed AS (
 SELECT seq, unique_key, agency, complaint_type, descriptor,
  coalesce(open_data_channel_type, channel_type) AS channel_type,
  lower(status) AS status, upper(borough) AS borough,
  coalesce(incident_zip, '00000') AS zip_code,
  coalesce(TRY_CAST(latitude AS DOUBLE), CAST(0 AS DOUBLE)) AS latitude,
  coalesce(TRY_CAST(longitude AS DOUBLE), CAST(0 AS DOUBLE)) AS longitude,
  coalesce(try_strptime(created_date, '%Y-%m-%dT%H:%M:%S.%g'),
           try_strptime(created_date, '%m/%d/%Y %I:%M:%S %p')) AS created_date
 FROM raw)"""

_ALL_REQUIRED = (
    "unique_key IS NOT NULL AND agency IS NOT NULL AND complaint_type IS NOT NULL AND "
    "channel_type IS NOT NULL AND status IS NOT NULL AND borough IS NOT NULL AND created_date IS NOT NULL"
)

CLEAN = f"""valid AS (SELECT * FROM parsed WHERE {_ALL_REQUIRED}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY unique_key ORDER BY seq) AS rn FROM valid),
clean AS (
 SELECT unique_key, agency, complaint_type, descriptor, channel_type, status, borough, zip_code,
        latitude, longitude, created_date, seq FROM ranked WHERE rn = 1)"""

ERROR_FIELDS = """concat_ws(',',
  CASE WHEN unique_key IS NULL THEN 'unique_key' END, CASE WHEN agency IS NULL THEN 'agency' END,
  CASE WHEN complaint_type IS NULL THEN 'complaint_type' END, CASE WHEN channel_type IS NULL THEN 'channel_type' END,
  CASE WHEN status IS NULL THEN 'status' END, CASE WHEN borough IS NULL THEN 'borough' END,
  CASE WHEN created_date IS NULL THEN 'created_date' END)"""

_RAW_FIELDS = (
    "unique_key", "agency", "complaint_type", "descriptor", "open_data_channel_type", "channel_type",
    "status", "borough", "incident_zip", "latitude", "longitude", "created_date",
)
# The original record as JSON text: fields without a value are left out.
_RECORD = "'{' || concat_ws(',', " + ", ".join(
    f"'\"{c}\":\"' || replace(replace(raw.{c}, '\\', '\\\\'), '\"', '\\\"') || '\"'" for c in _RAW_FIELDS
) + ") || '}'"

QUARANTINE = f"""rejected AS (SELECT * FROM parsed WHERE NOT ({_ALL_REQUIRED})),
quarantined AS (
 SELECT CAST(0 AS BIGINT) AS batch_id, rejected.seq, coalesce(rejected.unique_key, 'unknown') AS record_id,
        'validation_error' AS error_type, error_fields,
        'invalid or missing: ' || replace(error_fields, ',', ', ') AS error_message, {_RECORD} AS original_record
 FROM (SELECT *, {ERROR_FIELDS} AS error_fields FROM rejected) AS rejected JOIN raw ON raw.seq = rejected.seq)"""

# The published feed: raw rows with two more fields; every row has its own channel_type column.
FEED = """feed AS (SELECT raw.*, 'R' || CAST(seq AS VARCHAR) AS request_ref,
 CASE WHEN seq % 5 <> 0 THEN 'Agency of ' || borough END AS agency_name FROM raw)"""

# What a strict reader makes of the typed lines: numeric keys are no strings, a null alias wins.
PARSED_STRICT = """parsed AS (SELECT * REPLACE (
  CASE WHEN seq % 19 <> 0 THEN unique_key END AS unique_key,
  CASE WHEN seq % 23 <> 0 THEN channel_type END AS channel_type) FROM parsed_lenient)"""


def _with(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _on_raw(body: str) -> str:
    return _with(body, RAW)


def _on_parsed(body: str) -> str:
    return _with(body, RAW, PARSED)


def _on_clean(body: str) -> str:
    return _with(body, RAW, PARSED, CLEAN)


_CLEAN_ALL = _on_clean("SELECT * FROM clean")
_BOROUGH_COUNT = _on_clean("SELECT count(*) AS count FROM clean WHERE borough = 'BROOKLYN'")
_SLICE = (
    "SELECT 'BROOKLYN' AS borough, 'click-1' AS complaint_type, count(*) AS count FROM clean "
    "WHERE borough = 'BROOKLYN' AND complaint_type = 'click-1'"
)

_RAW_COLS = [
    "unique_key", "agency", "complaint_type", "descriptor", "open_data_channel_type", "channel_type",
    "status", "borough", "incident_zip", "latitude", "longitude", "created_date",
]
_NULL_RANK = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {i} AS ordinal, count(*) - count({c}) AS nulls, count(*) AS rows FROM raw"
    for i, c in enumerate(_RAW_COLS)
)

_CLEAN_COLS = [
    ("unique_key", False), ("agency", False), ("complaint_type", False), ("descriptor", False),
    ("channel_type", False), ("status", False), ("borough", False), ("zip_code", False),
    ("latitude", True), ("longitude", True), ("created_date", False), ("seq", True),
]


def _health_row(i: int, c: str, zero_counted: bool) -> str:
    zeros = f"count(*) FILTER (WHERE {c} = 0)" if zero_counted else "CAST(0 AS BIGINT)"
    return (
        f"SELECT '{c}' AS column_name, {i} AS ordinal, count(*) - count({c}) AS nulls, "
        f"round(CAST(100 * (count(*) - count({c})) AS DOUBLE) / count(*), 2) AS null_pct, "
        f"{zeros} AS zeros, round(CAST(100 * {zeros} AS DOUBLE) / count(*), 2) AS zero_pct, "
        f"count(*) AS rows FROM clean"
    )


_HEALTH = " UNION ALL ".join(_health_row(i, c, z) for i, (c, z) in enumerate(_CLEAN_COLS))

_SUMMARY = """answers AS (
 SELECT 'borough_volume' AS aggregation_name, borough AS key, count(*) AS count, NULL::INTEGER AS hour FROM clean GROUP BY borough
 UNION ALL SELECT 'top_complaint_types', complaint_type, count(*), NULL::INTEGER FROM clean GROUP BY complaint_type
 UNION ALL SELECT 'complaints_by_hour', CAST(hour(created_date) AS VARCHAR), count(*), CAST(hour(created_date) AS INTEGER) FROM clean GROUP BY hour(created_date)
 UNION ALL SELECT 'reporting_channels', channel_type, count(*), NULL::INTEGER FROM clean GROUP BY channel_type),
positioned AS (
 SELECT *, CAST(row_number() OVER (PARTITION BY aggregation_name
   ORDER BY hour ASC NULLS LAST, CASE WHEN hour IS NULL THEN count END DESC NULLS LAST, key) AS INTEGER) AS position
 FROM answers),
kept AS (SELECT * FROM positioned WHERE aggregation_name <> 'top_complaint_types' OR position <= 5)"""

_FEED_COLS = ["unique_key", "agency", "complaint_type", "descriptor", "open_data_channel_type", "channel_type", "status",
              "borough", "incident_zip", None, "latitude", "longitude", "created_date", "agency_name", "request_ref"]
_FEED_RANK = " UNION ALL ".join(
    f"SELECT '{c or 'zip_code'}' AS column_name, {i} AS ordinal, count(*) - count({c or 'NULL'}) AS nulls, count(*) AS rows FROM feed"
    for i, c in enumerate(_FEED_COLS)
)
_LENIENT = PARSED.replace("parsed AS", "parsed_lenient AS", 1)
_ARRIVALS = f"""bounds AS (SELECT min(seq) AS lo, max(seq) AS hi, (max(seq) - min(seq)) // 4 + 1 AS width FROM raw),
checked AS (SELECT (seq - lo) // width AS batch_id, unique_key, seq, {_ALL_REQUIRED} AS ok FROM parsed, bounds),
firsts AS (SELECT unique_key, min(seq) AS seq FROM checked WHERE ok GROUP BY unique_key)"""

_OPEN_B = "b0 <= 'BROOKLYN' AND b1 >= 'BROOKLYN'"
_OPEN_T = " AND t0 <= 'click-1' AND t1 >= 'click-1'"


def _files(name: str, file: str) -> str:
    """Rows and ends of each file of a layout."""
    return (
        f"{name} AS (SELECT file, count(*) AS n, min(borough) AS b0, max(borough) AS b1, min(complaint_type) AS t0, "
        f"max(complaint_type) AS t1 FROM (SELECT *, {file} AS file FROM clean) t GROUP BY file)"
    )


ORACLE_SQL: dict[str, str] = {
    "feed_landing": _with("SELECT unique_key, request_ref, agency_name FROM feed", RAW, FEED),
    "feed_profile": _with(f"SELECT * FROM ({_FEED_RANK}) t ORDER BY nulls DESC, ordinal LIMIT 15", RAW, FEED),
    # Keys in the typed lines: numbers where 19 divides seq, an explicit null where 23 does; no other null is written.
    "feed_schema": _on_raw(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, '{types}' AS types, '{merged}' AS merged_type, count({value}) AS filled, "
            f"{nulls} AS nulls, count(*) - count({value}) - {nulls} AS absent FROM raw"
            for c, types, merged, value, nulls in (
                ("seq", "number", "BIGINT", "seq", "0"),
                ("unique_key", "number,string", "VARIANT", "unique_key", "0"),
                ("open_data_channel_type", "null,string", "STRING", "CASE WHEN seq % 23 <> 0 THEN open_data_channel_type END",
                 "count(*) FILTER (WHERE seq % 23 = 0)"),
                ("channel_type", "string", "STRING", "CASE WHEN seq % 23 = 0 THEN 'PHONE' ELSE channel_type END", "0"),
                *[(c, "string", "STRING", c, "0") for c in ("agency", "complaint_type", "descriptor", "status", "borough",
                                                            "incident_zip", "latitude", "longitude", "created_date")],
            )
        )
    ),
    "raw_fallback": _with(
        "SELECT 'store' AS source, count(*) AS count, count(DISTINCT unique_key) AS keys FROM feed WHERE request_ref LIKE '%7' "
        "UNION ALL SELECT 'file', count(*), count(DISTINCT unique_key) FROM feed UNION ALL SELECT 'nothing', 0, 0", RAW, FEED,
    ),
    "feed_quarantine": _with(
        "SELECT record_id, error_fields, feed.request_ref, feed.agency_name, feed.created_date "
        "FROM quarantined JOIN feed USING (seq)", RAW, PARSED, QUARANTINE, FEED,
    ),
    "feed_dedup": _on_clean("SELECT * EXCLUDE (seq) FROM clean"),
    # Odd records land first; of a key the row that landed first stays.
    "batch_two_runs": _with(
        f"""SELECT 'clean' AS table_name, CAST(-1 AS BIGINT) AS batch_id, unique_key AS record_id, '' AS error_fields,
         status, borough, zip_code, created_date
        FROM (SELECT *, row_number() OVER (PARTITION BY unique_key ORDER BY 1 - seq % 2, seq) AS rn FROM parsed WHERE {_ALL_REQUIRED}) t
        WHERE rn = 1
        UNION ALL SELECT 'quarantine', 1 - seq % 2, record_id, error_fields, NULL, NULL, NULL, NULL FROM quarantined""",
        RAW, PARSED, QUARANTINE,
    ),
    "clean_strict": _with("SELECT * FROM clean", RAW, _LENIENT, PARSED_STRICT, CLEAN),
    "validate_strict": _with(
        f"SELECT seq, CASE WHEN {_ALL_REQUIRED} THEN 1 ELSE 0 END AS is_valid FROM parsed", RAW, _LENIENT, PARSED_STRICT
    ),
    # Files of 1000 rows, in the order of arrival and of (borough, type, key); a file is examined if its ends
    # enclose the value.  The hive layout has a folder for each borough.
    "layout_scan_report": _with(
        "SELECT layout, filter, rows_returned, rows_examined, rows_examined / nullif(rows_returned, 0) AS ratio FROM (" +
        " UNION ALL ".join(
            f"SELECT '{kind}' AS layout, '{cond.replace(chr(39), chr(39) * 2)}' AS filter, "
            f"(SELECT count(*) FROM clean WHERE {cond}) AS rows_returned, "
            f"(SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM {files} WHERE {opened}) AS rows_examined"
            for kind, files, cond, opened in (
                ("flat", "arrival", "borough = 'BROOKLYN'", _OPEN_B),
                ("hive", "hive", "borough = 'BROOKLYN'", _OPEN_B),
                ("flat", "arrival", "borough = 'BROOKLYN' AND complaint_type = 'click-1'", _OPEN_B + _OPEN_T),
                ("clustered", "clustered", "borough = 'BROOKLYN' AND complaint_type = 'click-1'", _OPEN_B + _OPEN_T),
            )
        ) + ") t",
        RAW, PARSED, CLEAN,
        _files("arrival", "(row_number() OVER (ORDER BY seq) - 1) // 1000"),
        _files("clustered", "(row_number() OVER (ORDER BY borough, complaint_type, unique_key) - 1) // 1000"),
        _files("hive", "borough"),
    ),
    "layout_curve_slices": _on_clean(
        "SELECT borough, count(*) AS count, 'complaint_type' AS filter FROM clean WHERE complaint_type = 'click-1' GROUP BY borough "
        "UNION ALL SELECT borough, count(*), 'created_date' FROM clean "
        "WHERE created_date BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-04' GROUP BY borough"
    ),
    "ingest_progress": _with(
        "SELECT batch_id, count(*) AS rows, count(*) FILTER (WHERE NOT ok) AS bad, count(*) FILTER (WHERE ok) AS valid, "
        "count(firsts.seq) AS written, count(*) FILTER (WHERE ok) - count(firsts.seq) AS duplicates "
        "FROM checked LEFT JOIN firsts ON firsts.seq = checked.seq GROUP BY batch_id", RAW, PARSED, _ARRIVALS,
    ),
    "rollup_maintained": _with(
        """SELECT aggregation_name, key, NULL AS other_key, count, replayed FROM kept, (VALUES (false), (true)) AS v(replayed)
        UNION ALL SELECT 'slices', borough, complaint_type, count(*), replayed
        FROM clean, (VALUES (false), (true)) AS v(replayed) GROUP BY borough, complaint_type, replayed""",
        RAW, PARSED, CLEAN, _SUMMARY,
    ),
    "src_jsonl": _on_raw(
        "SELECT seq, unique_key, agency, complaint_type, descriptor, open_data_channel_type, channel_type, "
        "status, borough, incident_zip, CAST(NULL AS VARCHAR) AS zip_code, latitude, longitude, created_date, "
        "CAST(NULL AS VARCHAR) AS _corrupt_record FROM raw"
    ),
    "land_raw": _on_raw("SELECT * FROM raw"),
    "scan_drop": _on_raw("SELECT * EXCLUDE (seq) FROM raw"),
    "sample_head": _on_raw("SELECT unique_key, seq FROM raw ORDER BY seq LIMIT 1000"),
    "sample_systematic": (
        "SELECT event_id, rank FROM (SELECT event_id, row_number() OVER (ORDER BY ts DESC, event_id) - 1 AS rank "
        "FROM events) t WHERE rank % 1000 < 100"
    ),
    "pick_slice": _on_clean(
        "SELECT borough, complaint_type FROM clean WHERE borough IS NOT NULL AND complaint_type IS NOT NULL "
        "ORDER BY borough, complaint_type LIMIT 1"
    ),
    "clean_requests": _CLEAN_ALL,
    "quarantine": _with("SELECT * FROM quarantined", RAW, PARSED, QUARANTINE),
    "summary_publish": _with(
        "SELECT aggregation_name, position, key, count, "
        "CAST(count(*) OVER (PARTITION BY aggregation_name) AS INTEGER) AS record_count FROM kept",
        RAW, PARSED, CLEAN, _SUMMARY,
    ),
    "export_csv": _CLEAN_ALL,
    "clean_alias": _on_parsed("SELECT seq, channel_type, zip_code FROM parsed"),
    "clean_timestamp": _on_parsed("SELECT seq, created_date FROM parsed"),
    "clean_coords": _on_parsed("SELECT seq, latitude, longitude FROM parsed"),
    "clean_defaults": _on_parsed("SELECT seq, zip_code, latitude, longitude FROM parsed"),
    "clean_case": _on_parsed("SELECT seq, borough, status FROM parsed"),
    "validate_split": _on_parsed(
        f"SELECT seq, CASE WHEN {_ALL_REQUIRED} THEN 1 ELSE 0 END AS is_valid FROM parsed"
    ),
    "dedup_keep_first": _CLEAN_ALL,
    "dedup_cross_batch": _CLEAN_ALL,
    "q1_region_volume": _on_clean("SELECT borough, count(*) AS count FROM clean GROUP BY borough"),
    "q2_top_types": _on_clean(
        "SELECT complaint_type, count(*) AS count FROM clean GROUP BY complaint_type "
        "ORDER BY count DESC, complaint_type LIMIT 5"
    ),
    "q3_hourly": _on_clean(
        "SELECT CAST(hour(created_date) AS INTEGER) AS hour, count(*) AS count FROM clean GROUP BY 1"
    ),
    "q4_channels": _on_clean("SELECT channel_type, count(*) AS count FROM clean GROUP BY channel_type"),
    "q4_channel_share": _on_clean(
        "SELECT channel_type, count(*) AS count, "
        "round(100 * CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (), 1) AS pct "
        "FROM clean GROUP BY channel_type"
    ),
    "table_count": _on_clean("SELECT count(*) AS count FROM clean"),
    "slice_count": _on_clean(_SLICE),
    "slice_rollup": _on_clean(
        "SELECT borough, complaint_type, count(*) AS count FROM clean GROUP BY borough, complaint_type"
    ),
    "region_distinct": _on_clean("SELECT DISTINCT borough FROM clean WHERE borough IS NOT NULL"),
    "quarantine_by_type": _with(
        "SELECT error_type, error_fields, count(*) AS count FROM quarantined GROUP BY error_type, error_fields",
        RAW, PARSED, QUARANTINE,
    ),
    "union_frames": _CLEAN_ALL,
    "profile_raw_nulls": _on_raw(f"SELECT * FROM ({_NULL_RANK}) t ORDER BY nulls DESC, ordinal LIMIT 15"),
    "profile_clean": _on_clean(_HEALTH),
    "layout_flat_count": _BOROUGH_COUNT,
    "layout_hive_count": _BOROUGH_COUNT,
    "layout_equivalence": _on_clean(
        "SELECT n AS flat_n, n AS hive_n, true AS same FROM "
        "(SELECT count(*) AS n FROM clean WHERE borough = 'BROOKLYN') t"
    ),
    "layout_clustered_slice": _on_clean(_SLICE),
    "layout_hash_spread": _on_clean(
        "SELECT borough, CAST(CAST('0x' || substr(md5(unique_key), 1, 8) AS BIGINT) % 4 AS INTEGER) AS bucket, "
        "count(*) AS count FROM clean GROUP BY 1, 2"
    ),
    "ingest_resumable": _CLEAN_ALL,
    "ingest_compacted": _CLEAN_ALL,
}
