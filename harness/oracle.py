"""The SQL that each query is checked against, in DuckDB's dialect, written apart from the Spark code."""

from __future__ import annotations

from harness.adapters import AS_OF, SPLIT_A, SPLIT_B

NOW = f"TIMESTAMP '{AS_OF}'"
AT_A, AT_B = f"TIMESTAMP '{SPLIT_A}'", f"TIMESTAMP '{SPLIT_B}'"
ISO = "'%Y-%m-%dT%H:%M:%S.%fZ'"


def iso(ts: str) -> str:
    return f"strftime({ts}, {ISO})"


def folder(source: str, ts: str, batch: str, hour: str = "'%H'") -> str:
    return (
        f"'source={source}/dt=' || strftime({ts}, '%Y-%m-%d') || '/hour=' || strftime({ts}, {hour})"
        f" || '/batch_id=' || {batch}"
    )


CATEGORY = "'k' || regexp_extract(props, '\"k\": *([0-9]+)', 1)"
ID_A = "CAST(user_id AS VARCHAR) || '-' || event_type"


def raw_a(id_: str = ID_A, updated: str = "ts") -> str:
    day = folder("api_a", "date_trunc('day', ts)", "strftime(ts, '%Y%m%d')")
    return f"""
    SELECT event_id AS ordinal, {id_} AS id, ts AS created_at, {updated} AS updated_at,
           event_type || ' ' || user_id AS name,
           CASE event_id % 3 WHEN 0 THEN 'new' WHEN 1 THEN 'active' ELSE 'closed' END AS status,
           event_type, CAST(CAST(value AS DECIMAL(38,0)) AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS description,
           {CATEGORY} AS category, event_type AS tags,
           ts + to_minutes(event_id % 97) AS ingested_at, strftime(ts, '%Y%m%d') AS batch_id,
           {day} || '/part-0001.jsonl' AS file_name
    FROM events"""


def raw_b(key: str = "o_orderkey") -> str:
    month = folder("api_b", "o_orderdate", "strftime(o_orderdate, '%Y%m')")
    return f"""
    SELECT o_orderkey AS ordinal, CAST({key} AS VARCHAR) AS id, o_orderdate AS created_at, o_orderdate AS modified_at,
           'order ' || o_orderkey AS title, o_orderstatus AS state, o_orderpriority AS priority,
           CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(NULL AS VARCHAR) AS notes,
           CAST(o_custkey AS VARCHAR) AS user_id, c_name AS user_name,
           o_orderdate + to_minutes(o_orderkey % 97) AS ingested_at, strftime(o_orderdate, '%Y%m') AS batch_id,
           {month} || '/part-0001.jsonl' AS file_name
    FROM orders JOIN customer ON o_custkey = c_custkey"""


NULLS_A = raw_a(f"CASE WHEN event_id % 101 <> 0 THEN {ID_A} END", "CASE WHEN event_id % 103 <> 0 THEN ts END")


def newest(rel: str, version: str, loaded: str = NOW, where: str = "true") -> str:
    return f"""
    SELECT * EXCLUDE (ordinal), {loaded} AS _loaded_at FROM {rel} WHERE {where}
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY {version} DESC NULLS LAST, ordinal) = 1"""


def with_clean(query: str, a: str | None = None, b: str | None = None) -> str:
    return f"""WITH raw_a AS ({a or raw_a()}), raw_b AS ({b or raw_b()}),
    clean_a AS ({newest('raw_a', 'updated_at')}), clean_b AS ({newest('raw_b', 'modified_at')}) {query}"""


AMOUNT_AS_DOUBLE = "* REPLACE (CAST(amount AS DOUBLE) AS amount)"


def merged(raw: str, version: str, at: str, loaded: str, columns: str = "*") -> str:
    """Two rules told apart: what the target keeps or takes over, and what is added."""
    return f"""WITH raw AS ({raw}),
    old AS ({newest('raw', version, at, f'created_at < {at}')}),
    new AS ({newest('raw', version, loaded, f'created_at >= {at} OR ordinal % 7 = 0')}),
    fresher AS (SELECT new.* FROM new JOIN old ON new.id = old.id AND new.{version} > old.{version}),
    unknown AS (SELECT * FROM new WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.id = new.id)),
    kept AS (SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM fresher WHERE fresher.id = old.id))
    SELECT {columns} FROM (SELECT * FROM kept UNION ALL SELECT * FROM fresher UNION ALL SELECT * FROM unknown)"""


# Messy records of source A: what a valid one looks like when normalised.
STAMPS = f"""CASE event_id % 5
    WHEN 2 THEN {iso("date_trunc('millisecond', ts)")}
    WHEN 3 THEN {iso("date_trunc('second', ts)")}
    WHEN 4 THEN {iso("date_trunc('second', ts)")}
    ELSE {iso('ts')} END"""
VALID = "event_id % 11 <> 0 AND event_id % 13 <> 0 AND event_id % 17 <> 0"
ID_ERROR = """CASE WHEN event_id % 11 = 0 THEN 'Missing required field: id'
    WHEN event_id % 13 = 0 THEN 'Null value for required field: id'
    WHEN event_id % 17 = 0 THEN 'Empty value for required field: id' END"""
META = f"""'{{"category_name":"' || {CATEGORY} || '","tag_list":[" raw ",{{"sub_key":"x"}}]}}'"""
TRANSFORMED_A = f"""SELECT event_id AS ordinal, {ID_A} AS id, {iso('ts')} AS created_at, {STAMPS} AS updated_at,
    'user ' || user_id AS user_name, event_type, {META} AS meta_data, {CATEGORY} AS category
    FROM events WHERE {VALID}
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC, ordinal) = 1"""


def transformed_b(select: str) -> str:
    return f"""SELECT {select} FROM orders WHERE o_orderkey % 19 <> 0
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1"""


def share(part: str, total: str) -> str:
    """Percentage rounded half up to two digits, in whole numbers."""
    return f"CAST((20000 * {part} + {total}) // (2 * {total}) AS DOUBLE) / 100"


FRESH = """SELECT '{name}' AS source, max({version}) AS latest_event_time, max(ingested_at) AS latest_ingestion_time,
    max(_loaded_at) AS latest_load_time, date_diff('minute', max({version}), {now}) AS event_age_minutes,
    date_diff('minute', max(ingested_at), {now}) AS ingestion_age_minutes,
    avg(date_diff('minute', {version}, ingested_at)) AS avg_ingestion_lag_minutes,
    max(date_diff('minute', {version}, ingested_at)) AS max_ingestion_lag_minutes, count(*) AS total_records,
    count(CASE WHEN CAST(ingested_at AS DATE) = CAST({now} AS DATE) THEN 1 END) AS records_today,
    CASE WHEN date_diff('hour', max(ingested_at), {now}) > 24 THEN 'STALE'
         WHEN date_diff('hour', max(ingested_at), {now}) > 6 THEN 'WARNING' ELSE 'HEALTHY' END AS freshness_status
    FROM {rel}"""
FRESHNESS = (
    FRESH.format(name="api_a", version="updated_at", now=NOW, rel="clean_a")
    + " UNION ALL "
    + FRESH.format(name="api_b", version="modified_at", now=NOW, rel="clean_b")
)
DAILY = " UNION ALL ".join(
    f"SELECT '{name}' AS source, CAST(created_at AS DATE) AS event_date, count(*) AS event_count,"
    f" count(DISTINCT id) AS unique_records FROM {rel} GROUP BY CAST(created_at AS DATE)"
    for name, rel in (("api_a", "clean_a"), ("api_b", "clean_b"))
)
DASHBOARD = f"""SELECT f.source, f.total_records, f.records_today, f.freshness_status, f.event_age_minutes,
    f.avg_ingestion_lag_minutes, d.event_count AS events_last_7_days
    FROM ({FRESHNESS}) f LEFT JOIN (
        SELECT source, CAST(sum(event_count) AS BIGINT) AS event_count FROM ({DAILY})
        WHERE event_date >= CAST({NOW} AS DATE) - 7 GROUP BY source) d ON f.source = d.source"""
HISTORY = " UNION ALL ".join(
    f"SELECT '{name}' AS source, batch_id, min(ingested_at) AS batch_start, max(ingested_at) AS batch_end,"
    f" count(*) AS record_count, count(DISTINCT id) AS unique_ids, min(file_name) AS file_name FROM {rel} GROUP BY batch_id"
    for name, rel in (("api_a", "clean_a"), ("api_b", "clean_b"))
)
CATEGORIES = f"""SELECT category, event_count, unique_records, first_seen, last_updated,
    {share('event_count', 'total')} AS pct_of_total FROM (
    SELECT category, count(*) AS event_count, count(DISTINCT id) AS unique_records, min(created_at) AS first_seen,
           max(updated_at) AS last_updated, CAST(sum(count(*)) OVER () AS BIGINT) AS total
    FROM clean_a WHERE category IS NOT NULL GROUP BY category)"""


def checks(a: str, b: str, now: str) -> str:
    """One SELECT per check and table, as four separate scans."""
    parts = []
    for rel, name in ((a, "CLEAN.CLN_API_A_EVENTS"), (b, "CLEAN.CLN_API_B_EVENTS")):
        head = f"'{name}' AS table_name, CAST(NULL AS VARCHAR) AS check_sql"
        age = f"date_diff('hour', max(ingested_at), {now})"
        parts += [
            f"SELECT 'row_count_check' AS check_name, 'completeness' AS check_type, {head}, CAST(count(*) AS DOUBLE) AS result_value,"
            f" CAST(1 AS DOUBLE) AS threshold_value, count(*) > 0 AS passed,"
            f" CASE WHEN count(*) = 0 THEN 'Table is empty - no records found' END AS error_message FROM {rel}",
            f"SELECT 'null_primary_key_check', 'validity', {head}, CAST(count(*) AS DOUBLE), CAST(0 AS DOUBLE), count(*) = 0,"
            f" CASE WHEN count(*) > 0 THEN 'Found ' || count(*) || ' records with NULL id' END FROM {rel} WHERE id IS NULL",
            f"SELECT 'freshness_check', 'timeliness', {head}, CAST({age} AS DOUBLE), CAST(6 AS DOUBLE), {age} <= 6,"
            f" CASE WHEN max(ingested_at) IS NULL THEN 'No data found - cannot check freshness'"
            f" WHEN {age} > 6 THEN 'Data is ' || {age} || ' hours old (threshold: 6 hours)' END FROM {rel}",
            f"SELECT 'duplicate_primary_key_check', 'uniqueness', {head}, CAST(count(*) AS DOUBLE), CAST(0 AS DOUBLE), count(*) = 0,"
            f" CASE WHEN count(*) > 0 THEN 'Found ' || count(*) || ' duplicate id values' END"
            f" FROM (SELECT id FROM {rel} GROUP BY id HAVING count(*) > 1)",
        ]
    return f"SELECT *, {now} AS executed_at, 'run-1' AS batch_id FROM ({' UNION ALL '.join(parts)})"


def with_checks(query: str) -> str:
    return with_clean(f", results AS ({checks('clean_a', 'raw_b', NOW)}) {query}", NULLS_A, raw_b("o_custkey"))


def daily_checks() -> str:
    moments = (AS_OF, "2024-01-30 04:00:00", "2024-01-22 04:00:00")
    runs = []
    for m in moments:
        known = [f"(SELECT * FROM {rel} WHERE ingested_at <= TIMESTAMP '{m}')" for rel in ("clean_a", "raw_b")]
        runs.append(f"({checks(known[0], known[1], f'TIMESTAMP {chr(39)}{m}{chr(39)}')})")
    union = " UNION ALL ".join(f"SELECT * FROM {r}" for r in runs)
    return with_clean(
        f""", results AS ({union}) SELECT CAST(executed_at AS DATE) AS check_date, count(*) AS total_checks,
        CAST(sum(CASE WHEN passed THEN 1 ELSE 0 END) AS BIGINT) AS passed,
        CAST(sum(CASE WHEN NOT passed THEN 1 ELSE 0 END) AS BIGINT) AS failed
        FROM results WHERE executed_at > {NOW} - INTERVAL 7 DAY GROUP BY 1""",
        NULLS_A,
        raw_b("o_custkey"),
    )


PAGES = """WITH e AS (SELECT event_id, event_type, event_id // 50 // 20 AS fetch_id, event_id // 50 % 20 AS page_no,
    event_id % 50 AS item_no, 50 AS size FROM events)
    SELECT fetch_id, page_no, item_no, event_id, event_type FROM e WHERE """

GOOD_ORDER = "o_orderkey % 50 <> 0 AND o_orderkey % 60 <> 1"
SPELLING = f"""CASE event_id % 12
    WHEN 0 THEN {iso('ts')} WHEN 1 THEN {iso("date_trunc('second', ts)")} WHEN 2 THEN {iso("date_trunc('millisecond', ts)")}
    WHEN 3 THEN {iso("date_trunc('second', ts)")} WHEN 4 THEN {iso('ts')} WHEN 5 THEN {iso("date_trunc('second', ts)")}
    WHEN 6 THEN {iso("date_trunc('day', ts)")} WHEN 7 THEN {iso("date_trunc('second', ts)")}
    WHEN 8 THEN CASE WHEN day(ts) <= 12 THEN
        {iso("make_timestamp(year(ts), day(ts), month(ts), hour(ts), minute(ts), CAST(second(ts) AS DOUBLE))")}
        ELSE {iso("date_trunc('second', ts)")} END END"""
SPELLING_UTC = f"""CASE event_id % 12
    WHEN 2 THEN {iso("date_trunc('millisecond', ts) - INTERVAL 330 MINUTE")}
    WHEN 3 THEN {iso("date_trunc('second', ts) + INTERVAL 7 HOUR")} ELSE {SPELLING} END"""
DAY = "strftime(ts, '%Y%m%d') AS batch_id"
SOURCE = "CASE WHEN user_id % 2 = 0 THEN 'api_a' ELSE 'api_b' END AS source"
SOURCE_RESULTS = f"""SELECT {DAY}, {SOURCE}, count(*) AS fetched, count(CASE WHEN event_type <> 'error' THEN 1 END) AS staged,
    bool_or(event_id % 997 = 0) AS broken FROM events GROUP BY 1, 2"""
RUNS = f"""SELECT batch_id, count(*) AS sources, CAST(sum(fetched) AS BIGINT) AS total_records_fetched,
    CAST(sum(staged) AS BIGINT) AS total_records_staged,
    CASE WHEN bool_or(broken) THEN 'partial_failure' ELSE 'success' END AS status FROM ({SOURCE_RESULTS}) GROUP BY batch_id"""
CENTS = "CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE)"
MOUNT = """'{"height":' || event_id % 90 || ',"rack":{"aisle":"' || event_type || '","level":"c' || event_id % 7 || '"}}'"""
PARTS = """'"parts":[{"code":"x9","left":' || event_id % 5 || '},{"code":"w","left":0}]'"""

ORACLE: dict[str, str] = {
    "read_jsonl": f"SELECT {ID_A} AS id, ts AS updated_at, {CATEGORY} AS category FROM events WHERE event_id % 50 <> 0",
    "land_raw_a": f"""SELECT {ID_A} AS id, ts AS updated_at, 'api_a' AS source, strftime(ts, '%Y%m%d') AS batch_id,
        {folder('api_a', "date_trunc('day', ts)", "strftime(ts, '%Y%m%d')")} AS folder FROM events""",
    "land_refresh": f"""SELECT CAST(CASE WHEN ts < {AT_A} THEN 0 ELSE 1 END AS BIGINT) AS load_id, count(*) AS row_count,
        count(DISTINCT strftime(ts, '%Y%m%d')) AS batches FROM events GROUP BY 1""",
    "land_raw_b": f"""SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderdate AS modified_at, 'api_b' AS source,
        strftime(o_orderdate, '%Y%m') AS batch_id, 'source=api_b/dt=' || strftime(o_orderdate, '%Y-%m') ||
        '/hour=00/batch_id=' || strftime(o_orderdate, '%Y%m') AS folder FROM orders WHERE {GOOD_ORDER}""",
    "stage_partition_scan": f"""SELECT ts AS updated_at, 'api_a' AS source, strftime(ts, '%Y-%m-%d') AS dt, '00' AS hour,
        strftime(ts, '%Y%m%d') AS batch_id FROM events WHERE ts >= {AT_A}""",
    "list_stage": f"""SELECT DISTINCT {folder('api_a', "date_trunc('day', ts)", "strftime(ts, '%Y%m%d')")} AS folder,
        true AS has_content FROM events""",
    "incremental_extract": "SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-20 12:00:00'",
    "unnest_pages_cursor": PAGES + "NOT (fetch_id % 3 = 0 AND page_no > 12)",
    "unnest_pages_offset": PAGES + """CASE WHEN fetch_id % 5 = 4 THEN page_no = 0
        WHEN fetch_id % 3 = 0 THEN page_no * size < 430 ELSE true END""",
    "write_jsonl_roundtrip": f"""SELECT event_id, ts, CASE WHEN event_id % 9 <> 0 THEN user_id END AS user_id,
        false AS user_id_missing, 'b1' AS batch_id, {iso(NOW)} AS extracted_at, '1.0' AS schema_version FROM events""",
    "write_parquet_roundtrip": f"""SELECT event_id, ts, CASE WHEN event_id % 9 <> 0 THEN user_id END AS user_id,
        'b1' AS batch_id, {iso(NOW)} AS extracted_at, '1.0' AS schema_version FROM events""",
    "write_report": """SELECT 'b1' AS batch_id, '1.0' AS schema_version, count(*) AS record_count, true AS has_content FROM events""",
    "retention_raw": """SELECT event_id AS ordinal, ts + to_minutes(event_id % 97) AS ingested_at, strftime(ts, '%Y%m%d') AS batch_id
        FROM events WHERE ts + to_minutes(event_id % 97) >= TIMESTAMP '2024-04-20 00:00:00' - INTERVAL 90 DAY""",
    "expired_days": """SELECT DISTINCT 'api_a' AS source, strftime(ts, '%Y-%m-%d') AS dt FROM events
        WHERE CAST(ts AS DATE) < DATE '2024-02-14' - 30""",
    "purge_expired": """SELECT 'api_a' AS source, strftime(ts, '%Y-%m-%d') AS dt, count(*) AS line_count FROM events
        WHERE CAST(ts AS DATE) >= DATE '2024-02-14' - 30 GROUP BY ALL""",
    "variant_extract_events": f"""SELECT event_id, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k,
        CAST(NULL AS INTEGER) AS type_as_number, {CATEGORY} AS category,
        CAST(CAST(value AS DECIMAL(38,0)) AS DOUBLE) AS value FROM events""",
    "clean_a_full": f"WITH raw AS ({NULLS_A}) {newest('raw', 'updated_at')}",
    "clean_b_full": f"SELECT {AMOUNT_AS_DOUBLE} FROM (WITH raw AS ({raw_b('o_custkey')}) {newest('raw', 'modified_at')})",
    "cast_quarantine": "SELECT event_id, 'value' AS cast_errors FROM events WHERE event_id % 29 = 0",
    "latest_per_key": """SELECT event_id, user_id, event_type, ts, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) = 1""",
    "duplicate_keys": """SELECT 'lineitem duplicates' AS check_name, count(*) AS duplicate_count
        FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
        UNION ALL SELECT 'orders duplicates', count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey HAVING count(*) > 1)
        UNION ALL SELECT 'API_A duplicates', 0""",
    "repeated_keys": """SELECT CASE WHEN event_id % 101 <> 0 THEN user_id END AS id, count(*) AS cnt FROM events
        GROUP BY 1 HAVING count(*) > 1""",
    "null_key_rows": f"SELECT ordinal, ingested_at, batch_id FROM ({NULLS_A}) WHERE id IS NULL",
    "merge_a": merged(NULLS_A, "updated_at", AT_A, NOW),
    "merge_b": merged(raw_b("o_custkey"), "modified_at", AT_B, NOW, AMOUNT_AS_DOUBLE),
    "merge_a_measured": merged(NULLS_A, "updated_at", AT_A, NOW),
    "incremental_slice": f"WITH raw AS ({raw_a()}) {newest('raw', 'updated_at', NOW, f'ingested_at > {AT_A}')}",
    "validate_required": f"""SELECT event_id AS ordinal,
        concat_ws('; ', {ID_ERROR}, 'Missing required field: region') AS errors FROM events""",
    "quarantine": f"SELECT event_id AS record_index, {ID_ERROR} AS errors, event_type FROM events WHERE NOT ({VALID})",
    "flatten_nested": f"""SELECT event_id AS id, '{{"device_model":"' || user_id || '","device_mount_height":' || event_id % 90 ||
        ',"device_mount_rack_aisle":"' || event_type || '","device_mount_rack_level":"c' || event_id % 7 || '","id":' || event_id ||
        ',' || {PARTS} || '}}' AS flat FROM events""",
    "flatten_two_levels": f"""SELECT event_id AS id, '{{"device.model":"' || user_id || '","device.mount":' || {MOUNT} ||
        ',"id":' || event_id || ',' || {PARTS} || '}}' AS flat FROM events""",
    "flatten_typed": """SELECT event_id AS id, CAST(user_id AS VARCHAR) AS device_model, event_id % 90 AS device_mount_height,
        event_type AS device_mount_rack_aisle, 'c' || event_id % 7 AS device_mount_rack_level,
        CAST(2 AS BIGINT) AS n_parts FROM events""",
    "normalize_keys": """SELECT event_id, '{"event_type":"' || event_type || '","hidden":null,"some_apikey":"x","total_amount":' ||
        event_id || ',"user_id":' || user_id || '}' AS record,
        '{"event_type":"' || event_type || '","hidden":null,"some_api_key":"x","total_amount":' ||
        event_id || ',"user_id":' || user_id || '}' AS record_split FROM events""",
    "key_report": """SELECT '' AS name, CAST(1 AS BIGINT) AS spellings, '!!' AS first_spelling, '!!' AS last_spelling,
        count(*) AS occurrences FROM events
        UNION ALL SELECT 'user_id', 2, 'userId', 'user_id', count(*) + count(CASE WHEN event_id % 4 = 0 THEN 1 END) FROM events""",
    "trim_strings": """SELECT doc_id, md5(t) AS digest, CAST(length(t) AS BIGINT) AS n_chars FROM (SELECT doc_id, trim(text,
        chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || ' ' || chr(133) ||
        chr(160) || chr(5760) || chr(8192) || chr(8193) || chr(8194) || chr(8195) || chr(8196) || chr(8197) || chr(8198) ||
        chr(8199) || chr(8200) || chr(8201) || chr(8202) || chr(8232) || chr(8233) || chr(8239) || chr(8287) || chr(12288)) AS t
        FROM documents)""",
    "normalize_ts": f"""SELECT event_id, {SPELLING} AS normal, {SPELLING_UTC} AS normal_utc,
        CASE WHEN event_id % 2 = 0 THEN {iso("date_trunc('millisecond', ts)")} ELSE {iso("date_trunc('second', ts)")} END
        AS from_epoch FROM events""",
    "normalize_records": f"""SELECT event_id AS ordinal, '{{"created_at":"' || {iso('ts')} || '","event_type":"' || event_type || '",' ||
        CASE WHEN event_id % 11 = 0 THEN '' WHEN event_id % 13 = 0 THEN '"id":null,' WHEN event_id % 17 = 0 THEN '"id":"",'
             ELSE '"id":"' || {ID_A} || '",' END || '"meta_data":' || {META} || ',"updated_at":"' || {STAMPS} ||
        '","user_name":"user ' || user_id || '"}}' AS record FROM events""",
    "normalize_typed": f"""SELECT event_id, {SPELLING} AS created_at, event_type AS type_name, {iso('ts')} AS updated_at FROM events""",
    "dedupe_first": """SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""",
    "dedupe_last": """SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""",
    "dedupe_unsorted": """SELECT min(event_id) AS event_id, user_id FROM events WHERE event_id % 101 <> 0 GROUP BY user_id""",
    "dedupe_composite": """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity) = 1""",
    "transform_a": f"SELECT ordinal, id, created_at, updated_at, user_name, event_type, meta_data FROM ({TRANSFORMED_A})",
    "transform_b": transformed_b(
        f"o_orderkey AS ordinal, CAST(o_custkey AS VARCHAR) AS id, {iso('o_orderdate')} AS created_at,"
        f" {iso('o_orderdate')} AS modified_at, o_orderstatus AS order_state, CAST(o_orderkey AS VARCHAR) AS amount"
    ),
    "transform_records": f"""SELECT event_type, category AS meta_data_category_name, count(*) AS records, 'valid' AS outcome
        FROM ({TRANSFORMED_A}) GROUP BY 1, 2 UNION ALL
        SELECT event_type, {CATEGORY}, count(*), 'rejected' FROM events WHERE NOT ({VALID}) GROUP BY 1, 2""",
    "daily_event_counts": with_clean(DAILY),
    "daily_summary": with_clean(f"SELECT *, {NOW} AS refreshed_at FROM ({DAILY})"),
    "data_freshness": with_clean(FRESHNESS),
    "ingestion_history": with_clean(HISTORY),
    "ingestion_history_exact": with_clean(HISTORY.replace("clean_", "raw_"), b=raw_b("o_custkey")),
    "top_categories": with_clean(CATEGORIES),
    "top_k_categories": with_clean(CATEGORIES + " ORDER BY event_count DESC, category LIMIT 10"),
    "status_distribution": with_clean(
        f"SELECT status, n AS count, {share('n', 'total')} AS percentage FROM (SELECT status, count(*) AS n,"
        " CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM clean_a GROUP BY status)"
    ),
    "priority_distribution": with_clean(
        "SELECT priority, state, count(*) AS count, CAST(sum(amount) AS DOUBLE) AS total_amount,"
        " round(CAST(sum(amount) AS DOUBLE) / count(*), 6) AS avg_amount FROM clean_b GROUP BY priority, state"
    ),
    "hourly_activity": with_clean(
        "SELECT source, hour(created_at) AS hour_of_day, strftime(created_at, '%a') AS day_of_week, count(*) AS event_count"
        " FROM (SELECT 'api_a' AS source, created_at FROM clean_a UNION ALL SELECT 'api_b', created_at FROM clean_b)"
        " GROUP BY 1, 2, 3"
    ),
    "executive_dashboard": with_clean(DASHBOARD),
    "executive_dashboard_joined": with_clean(DASHBOARD),
    "clean_stats": with_clean(
        "SELECT 'CLN_API_A_EVENTS' AS table_name, count(*) AS total_rows, max(_loaded_at) AS last_load FROM clean_a"
        " UNION ALL SELECT 'CLN_API_B_EVENTS', count(*), max(_loaded_at) FROM clean_b"
    ),
    "table_counts": with_clean(
        "SELECT 'API_A_EVENTS' AS table_name, count(*) AS row_count FROM raw_a UNION ALL"
        " SELECT 'API_B_EVENTS', count(*) FROM raw_b UNION ALL SELECT 'CLN_API_A_EVENTS', count(*) FROM clean_a"
        " UNION ALL SELECT 'CLN_API_B_EVENTS', count(*) FROM clean_b"
    ),
    "recent_updates": with_clean(
        f"SELECT id, updated_at, status, value FROM clean_a WHERE updated_at > {NOW} - INTERVAL 1 DAY"
    ),
    "volume_trend_7d": with_clean(f"SELECT * FROM ({DAILY}) WHERE event_date > CAST({NOW} AS DATE) - 7"),
    "schema_drift": with_clean(
        f"""SELECT raw_field, CASE WHEN lower(raw_field) IN ('id', 'created_at', 'updated_at', 'name', 'status', 'value', 'description')
        THEN 'EXISTS' ELSE 'NEW' END AS status FROM (SELECT DISTINCT unnest(['id', 'created_at', 'updated_at', 'name', 'status',
        'type', 'value', 'description', 'metadata', 'new_field', 'ID']) AS raw_field FROM raw_a
        WHERE ingested_at > {NOW} - INTERVAL 1 DAY)"""
    ),
    "masked_view": """SELECT c_custkey, regexp_replace(c_name || '@example.com', '.+@', '***@') AS email,
        c_name || '@example.com' AS full_email FROM customer""",
    "raw_sample": f"SELECT ordinal, 'api_a' AS source, ingested_at, batch_id, id FROM ({raw_a()}) ORDER BY ordinal LIMIT 5",
    "dq_results": with_checks("SELECT * FROM results"),
    "dq_latest": with_checks("SELECT * EXCLUDE (check_sql, batch_id) FROM results"),
    "dq_summary": with_checks(
        """SELECT count(*) AS total_checks, CAST(sum(CASE WHEN passed THEN 1 ELSE 0 END) AS BIGINT) AS passed_checks,
        CAST(sum(CASE WHEN NOT passed THEN 1 ELSE 0 END) AS BIGINT) AS failed_checks,
        CAST(sum(CASE WHEN passed IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unknown_checks,
        round(100.0 * sum(CASE WHEN passed THEN 1 ELSE 0 END) / count(*), 2) AS pass_rate_pct FROM results"""
    ),
    "dq_alerts": with_checks("SELECT * EXCLUDE (check_sql, batch_id, passed) FROM results WHERE passed = false"),
    "dq_daily": daily_checks(),
    "dq_gate": with_checks(
        "SELECT check_name, table_name, result_value, error_message FROM results WHERE passed = false"
        " AND check_name IN ('null_primary_key_check', 'duplicate_primary_key_check')"
    ),
    "request_metrics": f"""SELECT {SOURCE}, {DAY}, count(*) AS total_requests,
        count(CASE WHEN event_type <> 'error' THEN 1 END) AS successful_requests,
        count(CASE WHEN event_type = 'error' THEN 1 END) AS failed_requests,
        CAST(sum(event_id % 3) AS BIGINT) AS total_retries, {CENTS} AS total_duration_ms,
        CAST((2 * CAST(100 * sum(CAST(value AS DECIMAL(18,2))) AS BIGINT) + count(*)) // (2 * count(*)) AS DOUBLE) / 100
        AS avg_duration_ms FROM events GROUP BY 1, 2""",
    "step_log_rollup": f"""SELECT {SOURCE}, {DAY},
        CASE event_id % 4 WHEN 0 THEN 'ingestion' WHEN 1 THEN 'api_fetch' WHEN 2 THEN 'transform' ELSE 's3_upload' END AS step,
        count(*) AS log_lines, count(CASE WHEN event_type = 'error' THEN 1 END) AS errors,
        count(CASE WHEN event_type NOT IN ('error', 'signup') THEN 1 END) AS successes, max(event_id % 500) AS row_count,
        {CENTS} AS total_duration_ms, CAST(max(event_id % 3) AS INTEGER) AS retry_count,
        'failure ' || max(CASE WHEN event_type = 'error' THEN event_id END) AS last_error,
        CASE WHEN bool_or(event_type = 'error') THEN 'error' WHEN bool_or(event_type <> 'signup') THEN 'success'
             ELSE 'started' END AS status FROM events WHERE event_id % 40 <> 0 GROUP BY 1, 2, 3""",
    "run_summary": RUNS,
    "run_metrics": f"""SELECT r.*, coalesce(total_checks, 0) AS total_checks, coalesce(passed, 0) AS passed,
        coalesce(failed, 0) AS failed FROM ({RUNS}) r LEFT JOIN (SELECT {DAY}, count(*) AS total_checks,
        count(CASE WHEN event_id % 5 <> 0 AND event_type <> 'error' THEN 1 END) AS passed,
        count(CASE WHEN event_id % 5 <> 0 AND event_type = 'error' THEN 1 END) AS failed
        FROM events GROUP BY 1) c USING (batch_id)""",
    "hourly_run": f"""WITH a AS (SELECT CAST(strptime(updated_at, {ISO}) AS TIMESTAMP) AS version,
            CAST(strptime(created_at, {ISO}) AS TIMESTAMP) AS created FROM ({TRANSFORMED_A})),
        b AS ({transformed_b('o_orderdate AS version, o_orderdate AS created')}),
        u AS (SELECT 'api_a' AS source, * FROM a UNION ALL SELECT 'api_b', * FROM b)
        SELECT source, count(*) AS total_records, count(*) AS records_today, 'HEALTHY' AS freshness_status,
        date_diff('minute', max(version), {NOW}) AS event_age_minutes,
        avg(date_diff('minute', version, {NOW})) AS avg_ingestion_lag_minutes,
        nullif(count(CASE WHEN CAST(created AS DATE) >= CAST({NOW} AS DATE) - 7 THEN 1 END), 0) AS events_last_7_days
        FROM u GROUP BY source""",
}

# The stream breaks ties by ingestion time; event times, and with them the outcome, are the same.
ORACLE["stream_upsert"] = merged(NULLS_A, "updated_at", NOW, NOW).replace(f"created_at < {NOW}", f"created_at < {AT_A}").replace(
    f"created_at >= {NOW}", f"created_at >= {AT_A}"
)

ORACLE["hourly_rerun"] = f"""WITH a AS ({TRANSFORMED_A}), b AS ({transformed_b('o_orderdate AS version')})
    SELECT 'api_a' AS part, count(*) AS row_count, count(*) AS ids FROM a UNION ALL SELECT 'api_b', count(*), count(*) FROM b
    UNION ALL VALUES ('checks r1', 8, 8), ('checks r2', 8, 8), ('metrics r1', 1, 1), ('metrics r2', 1, 1)"""

# Tables after two upserts, their summary and checks by a scan of all rows.
UPSERTED_A = f"({merged(NULLS_A, 'updated_at', AT_A, NOW)})"
UPSERTED_B = f"({merged(raw_b('o_custkey'), 'modified_at', AT_B, NOW)})"
ORACLE["summary_by_buckets"] = " UNION ALL ".join(
    f"SELECT '{name}' AS source, CAST(created_at AS DATE) AS event_date, count(*) AS event_count,"
    f" count(DISTINCT id) AS unique_records, {NOW} AS refreshed_at FROM {rel} GROUP BY CAST(created_at AS DATE)"
    for name, rel in (("api_a", UPSERTED_A), ("api_b", UPSERTED_B))
)
ORACLE["checks_by_buckets"] = f"WITH a AS {UPSERTED_A}, b AS {UPSERTED_B} {checks('a', 'b', NOW)}"

# Files of orders by month, with the place of every line.
ORDER_FILES = """SELECT strftime(o_orderdate, '%Y%m') AS batch_id, o_orderkey,
    o_orderkey % 50 = 0 AS bad, o_orderkey % 50 <> 0 AND o_orderkey % 60 <> 1 AS good,
    row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y%m') ORDER BY o_orderkey) AS line FROM orders"""
ORDER_LOADS = f"""SELECT batch_id, CASE WHEN count(*) FILTER (bad) = 0 THEN 'Loaded' WHEN count(*) FILTER (good) > 0 THEN 'Partially loaded' ELSE 'Load failed' END AS status,
    count(*) FILTER (good OR bad) AS row_parsed, count(*) FILTER (good) AS row_count, count(*) FILTER (bad) AS error_count,
    CASE WHEN count(*) FILTER (bad) > 0 THEN 'not a JSON value' END AS first_error_message,
    min(line) FILTER (bad) AS first_error_line_number, {NOW} AS last_load_time FROM ({ORDER_FILES}) GROUP BY batch_id"""
ORACLE["load_history"] = ORDER_LOADS
ORACLE["staged_history"] = f"SELECT * EXCLUDE (first_error_message, last_load_time) FROM ({ORDER_LOADS})"
ORACLE["load_errors"] = f"""SELECT batch_id, '{{"id": ' || o_orderkey AS line, 'not a JSON value' AS error, {NOW} AS rejected_at
    FROM ({ORDER_FILES}) WHERE bad"""
ORACLE["failed_loads"] = f"SELECT batch_id, status, first_error_line_number FROM ({ORDER_LOADS}) WHERE status <> 'Loaded'"

ORACLE["compact_raw"] = f"""SELECT CASE WHEN CAST(ingested_at AS DATE) < CAST({NOW} AS DATE) THEN 'c0' ELSE CAST(ordinal % 3 AS VARCHAR) END AS load_id,
    CAST(ingested_at AS DATE) AS ingest_day, count(*) AS row_count, count(DISTINCT ordinal) AS places FROM ({raw_a()}) GROUP BY 1, 2"""
ORACLE["purge_raw"] = f"""SELECT id, ingested_at, CAST(ingested_at AS DATE) AS ingest_day FROM ({raw_a()})
    WHERE CAST(ingested_at AS DATE) >= DATE '2024-04-20' - 90"""

ORACLE["unnest_pages_linked"] = PAGES + "CASE fetch_id % 4 WHEN 1 THEN page_no <= 12 WHEN 2 THEN page_no < 7 ELSE true END"
ORACLE["linked_pages_report"] = """WITH p AS (SELECT DISTINCT event_id // 50 // 20 AS fetch_id, event_id // 50 % 20 AS page_no FROM events),
    s AS (SELECT * FROM p WHERE NOT (fetch_id % 4 = 2 AND page_no = 7))
    SELECT fetch_id, count(*) + count(*) FILTER (fetch_id % 4 = 3 AND page_no = 3) AS n_stored, count(*) AS n_pages,
        count(*) FILTER (CASE fetch_id % 4 WHEN 1 THEN page_no <= 12 WHEN 2 THEN page_no < 7 ELSE true END) AS n_placed,
        count(*) FILTER (CASE fetch_id % 4 WHEN 1 THEN page_no > 12 WHEN 2 THEN page_no > 7 ELSE false END) AS n_lost,
        CASE fetch_id % 4 WHEN 1 THEN 'loop' WHEN 2 THEN 'gap' ELSE 'complete' END AS state FROM s GROUP BY fetch_id"""

ORACLE["masked_view_sql"] = """SELECT role, c_custkey, CASE WHEN role = 'TRANSFORMER_ROLE' THEN c_name || '@example.com' ELSE '***@example.com' END AS email, c_name
    FROM customer, (VALUES ('ANALYST_ROLE'), ('TRANSFORMER_ROLE'), (NULL)) AS r(role)"""
ID_ROWS = f"""(SELECT 'api_a' AS source, id, created_at, batch_id FROM ({raw_a()})
    UNION ALL SELECT 'api_b', id, created_at, batch_id FROM ({raw_b('o_custkey')}))"""
ORACLE["day_id_counts"] = f"""SELECT source, CAST(created_at AS DATE) AS event_date, batch_id, count(*) AS row_count, count(DISTINCT id) AS unique_ids
    FROM {ID_ROWS} GROUP BY ALL"""
ORACLE["weekly_distinct_ids"] = f"""SELECT source, CAST(date_trunc('week', created_at) AS DATE) AS week, count(*) AS row_count, count(DISTINCT id) AS unique_ids,
    true AS estimate_is_near FROM {ID_ROWS} GROUP BY ALL"""

ORACLE["normalize_source_order"] = """SELECT event_id AS ordinal, CASE WHEN event_id % 2 = 1 THEN user_id ELSE event_id END AS user_id,
    CASE WHEN event_id % 2 = 1 THEN event_id ELSE user_id END AS tag_no FROM events"""
