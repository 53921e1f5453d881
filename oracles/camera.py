"""SQL for the camera queries: landing to star in common table expressions."""

from __future__ import annotations

from sensorstar.sources.sample_landing import CAMERA_COLUMNS, as_sql

CZECH_MONTHS = "Leden Únor Březen Duben Květen Červen Červenec Srpen Září Říjen Listopad Prosinec".split()
FIELDS = ["detectionType", "utc", "lp", "sensor", "vehClass", "ilpc", "velocity"]
NUMBER = "'^\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*$'"
DIMENSIONS = ["city", "sensor", "plate", "detection_type", "vehicle_class", "country"]

CITY = """CASE WHEN starts_with(topic, '/') AND len(string_split(trim(topic, '/'), '/')) >= 3
  THEN string_split(trim(topic, '/'), '/')[1] ELSE 'Unknown' END"""

MONTH = "CASE month_num " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(CZECH_MONTHS, 1)) + " END"


def stacked(columns: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{d}' AS dimension, {c} AS member FROM {source}" for d, c in columns.items())


PRELUDE = f"""WITH landing AS ({as_sql(CAMERA_COLUMNS, "events")}),
fields AS (SELECT id, time, topic, {", ".join(f"CASE WHEN json_valid(payload) THEN payload->>'$.{f}' END AS {f}" for f in FIELDS)}
  FROM landing),
staging AS (SELECT id AS landing_id, time AS original_time, {CITY} AS city,
  nullif(trim(detectionType), '') AS detection_type, try_strptime(utc, '%Y-%m-%d %H:%M:%S.%f') AS utc,
  nullif(trim(lp), '') AS lp, nullif(trim(sensor), '') AS sensor, TRY_CAST(vehClass AS INTEGER) AS veh_class,
  nullif(trim(ilpc), '') AS ilpc, TRY_CAST(velocity AS INTEGER) AS velocity FROM fields),
naturals AS (SELECT landing_id, original_time, velocity, city, sensor, lp AS plate, detection_type,
  CAST(veh_class AS VARCHAR) AS vehicle_class, ilpc AS country FROM staging),
pairs AS ({stacked({d: d for d in DIMENSIONS}, "naturals")}),
member_uses AS (SELECT dimension, member, count(*) AS uses FROM pairs WHERE member IS NOT NULL GROUP BY ALL),
keyed AS (SELECT dimension, member, row_number() OVER (PARTITION BY dimension ORDER BY member) AS key FROM member_uses),
members AS (SELECT * FROM keyed UNION ALL SELECT unnest({DIMENSIONS!r}), 'UNKNOWN', -1),
minutes AS (SELECT ts AS full_date, CAST(1104071 + date_diff('minute', TIMESTAMP '2024-01-01', ts) AS INTEGER) AS time_key
  FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2025-12-31 23:59:00', INTERVAL 1 MINUTE) g(ts)),
calendar AS (SELECT time_key, full_date, CAST(year(full_date) AS INTEGER) AS year_num,
  CAST(month(full_date) AS INTEGER) AS month_num, CAST(day(full_date) AS INTEGER) AS day_num,
  CAST(isodow(full_date) AS INTEGER) AS day_of_week_num, CAST(hour(full_date) AS INTEGER) AS hour_num,
  CAST(minute(full_date) AS INTEGER) AS minute_num FROM minutes
  UNION ALL SELECT -1, TIMESTAMP '1900-01-01', 1900, 1, 1, 1, 0, 0),
facts AS (SELECT n.landing_id AS camera_detection_key,
  coalesce((CASE WHEN original_time >= TIMESTAMP '2024-01-01' AND original_time < TIMESTAMP '2026-01-01'
    THEN CAST(1104071 + date_diff('minute', TIMESTAMP '2024-01-01', date_trunc('minute', original_time)) AS INTEGER) END), -1) AS time_key,
  coalesce(s.key, -1) AS sensor_key, coalesce(t.key, -1) AS detection_type_key, coalesce(p.key, -1) AS lp_key,
  coalesce(o.key, -1) AS country_key, coalesce(v.key, -1) AS vehicle_class_key, coalesce(c.key, -1) AS city_key,
  CAST(velocity AS DOUBLE) AS velocity, original_time AS detection_time,
  CAST(date_trunc('week', original_time) AS DATE) AS week_bucket
  FROM naturals n
  LEFT JOIN keyed s ON s.dimension = 'sensor' AND s.member = n.sensor
  LEFT JOIN keyed t ON t.dimension = 'detection_type' AND t.member = n.detection_type
  LEFT JOIN keyed p ON p.dimension = 'plate' AND p.member = n.plate
  LEFT JOIN keyed o ON o.dimension = 'country' AND o.member = n.country
  LEFT JOIN keyed v ON v.dimension = 'vehicle_class' AND v.member = n.vehicle_class
  LEFT JOIN keyed c ON c.dimension = 'city' AND c.member = n.city),
star AS (SELECT f.*, k.* EXCLUDE (time_key), s.member AS sensor_code, t.member AS detection_type,
  p.member AS license_plate, o.member AS country_code, v.member AS vehicle_class, c.member AS city_name,
  true AS is_active
  FROM facts f LEFT JOIN calendar k ON k.time_key = f.time_key
  LEFT JOIN members s ON s.dimension = 'sensor' AND s.key = f.sensor_key
  LEFT JOIN members t ON t.dimension = 'detection_type' AND t.key = f.detection_type_key
  LEFT JOIN members p ON p.dimension = 'plate' AND p.key = f.lp_key
  LEFT JOIN members o ON o.dimension = 'country' AND o.key = f.country_key
  LEFT JOIN members v ON v.dimension = 'vehicle_class' AND v.key = f.vehicle_class_key
  LEFT JOIN members c ON c.dimension = 'city' AND c.key = f.city_key),
history AS (SELECT topic, 1 AS process_step,
  CASE WHEN max(day(time)) % 2 = 1 THEN min(id) ELSE max(id) END AS last_loaded_id, max(time) AS last_update
  FROM landing GROUP BY topic, CAST(time AS DATE))
"""

NEW_PLATES = """SELECT DISTINCT plate AS license_plate FROM naturals WHERE plate IS NOT NULL AND plate NOT IN
  (SELECT plate FROM naturals WHERE plate IS NOT NULL AND original_time < TIMESTAMP '2024-01-02')"""


def truthy(column: str) -> str:
    number = f"CASE WHEN regexp_matches({column}, {NUMBER}) THEN TRY_CAST({column} AS DOUBLE) END"
    return f"nullif(CAST(trunc({number}) AS INTEGER), 0)"


def number(column: str) -> str:
    return f"CASE WHEN regexp_matches({column}, {NUMBER}) THEN TRY_CAST(trim({column}) AS DOUBLE) END"


def keyed_columns(unknown: int) -> str:
    names = {"sensor_key": "s", "detection_type_key": "t", "lp_key": "p", "country_key": "o", "vehicle_class_key": "v", "city_key": "c"}
    return ", ".join(f"coalesce({a}.key, {unknown}) AS {n}" for n, a in names.items())


def batch_rows(source: str, key: str) -> str:
    return f"SELECT CAST(floor(({key} - 1) / 500) AS BIGINT) AS batch_no, count(*) AS n FROM {source} GROUP BY 1"


ORPHANS = " UNION ALL ".join(
    f"SELECT '{key}' AS key_column, count(DISTINCT {key}) AS orphan_keys, count(*) AS orphan_rows FROM facts "
    f"WHERE {key} NOT IN (SELECT {'time_key FROM calendar' if key == 'time_key' else f'key FROM members WHERE dimension = {dim!r}'})"
    for key, dim in {
        "city_key": "city", "sensor_key": "sensor", "lp_key": "plate", "detection_type_key": "detection_type",
        "vehicle_class_key": "vehicle_class", "country_key": "country", "time_key": "",
    }.items()
)

FACT_COLUMNS = (
    "camera_detection_key time_key sensor_key detection_type_key lp_key country_key vehicle_class_key city_key "
    "velocity detection_time"
).split()
KEYS = [c for c in FACT_COLUMNS if c.endswith("_key") and c != "camera_detection_key"]

STATEMENTS: dict[str, str] = {
    "incremental_scan": "SELECT * FROM landing WHERE topic LIKE '/Bilina/kamery/camea/%' AND id > 100",
    "topic_scan": "SELECT * FROM landing WHERE topic IN ('/Decin/kamery/camea/0', '/Usti/kamery/camea/1')",
    "topic_catalogue": "SELECT DISTINCT topic FROM landing",
    "latest_payloads": "SELECT topic, arg_max(payload, id) AS payload, max(id) AS id FROM landing GROUP BY topic",
    "dump_import": """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate END AS created,
        CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_totalprice AS DECIMAL(18, 2)) END AS amount FROM orders""",
    "csv_handoff": "SELECT landing_id, city, coalesce(lp, '') AS lp, velocity FROM staging",
    "batched_append": "SELECT topic, count(*) AS messages, max(id) AS last_id FROM landing GROUP BY topic",
    "week_chunks": """SELECT week_bucket, count(*) AS detections, min(time_key) AS first_key, max(time_key) AS last_key
        FROM facts GROUP BY week_bucket""",
    "camera_fields": f"SELECT id, {', '.join(FIELDS)} FROM fields",
    "city_rules": f"""SELECT topic, {CITY} AS city, nullif(trim(split_part(topic, '/', 2)), '') AS city_part,
        count(*) AS messages FROM landing GROUP BY topic""",
    "utc_times": "SELECT id, try_strptime(utc, '%Y-%m-%d %H:%M:%S.%f') AS utc FROM fields",
    "number_rules": f"""SELECT id, TRY_CAST(velocity AS INTEGER) AS velocity_whole,
        CASE WHEN regexp_matches(value, '^[+-]?[0-9]+$') THEN TRY_CAST(value AS INTEGER) END AS value_whole,
        {truthy("velocity")} AS velocity_truthy, {truthy("value")} AS value_truthy,
        {number("mixed")} AS mixed_number, coalesce(TRY_CAST(vehClass AS DOUBLE), 0) AS class_or_zero
        FROM (SELECT f.*, CAST(e.value AS VARCHAR) AS value,
          CASE WHEN f.id % 3 = 0 THEN f.velocity || 'f' ELSE CAST(e.value AS VARCHAR) END AS mixed
          FROM fields f JOIN events e ON e.event_id + 1 = f.id)""",
    "blank_rules": """SELECT id, coalesce(lp, '') AS lp_blank, coalesce(detectionType, '') AS type_blank,
        nullif(trim(lp), '') AS lp_null, nullif(trim(sensor), '') AS sensor_trimmed FROM fields""",
    "camera_staging": "SELECT *, true AS has_load_time FROM staging",
    "camera_staging_blanks": f"""SELECT id AS landing_id, time AS original_time, {CITY} AS city,
        coalesce(detectionType, '') AS detection_type, try_strptime(utc, '%Y-%m-%d %H:%M:%S.%f') AS utc,
        coalesce(lp, '') AS lp, coalesce(sensor, '') AS sensor, {truthy("vehClass")} AS veh_class,
        coalesce(ilpc, '') AS ilpc, {truthy("velocity")} AS velocity FROM fields""",
    "staging_mark": "SELECT count(*) AS rows_inserted, max(landing_id) AS max_landing_id FROM staging",
    "staging_rejects": """SELECT topic, count(*) AS messages,
        count(*) FILTER (coalesce(detectionType, utc, lp, sensor, vehClass, ilpc, velocity) IS NULL) AS bad_payloads,
        count(*) FILTER (vehClass IS NOT NULL AND TRY_CAST(vehClass AS INTEGER) IS NULL) AS bad_classes,
        count(*) FILTER (velocity IS NOT NULL AND TRY_CAST(velocity AS INTEGER) IS NULL) AS bad_velocities
        FROM fields GROUP BY topic""",
    "distinct_members": f"SELECT DISTINCT {', '.join(DIMENSIONS)} FROM naturals",
    "member_counts": "SELECT * FROM member_uses",
    "new_members_except": """SELECT plate AS license_plate FROM naturals WHERE plate IS NOT NULL EXCEPT
        SELECT plate FROM naturals WHERE plate IS NOT NULL AND original_time < TIMESTAMP '2024-01-02'""",
    "new_members_anti": NEW_PLATES,
    "new_members_not_in": NEW_PLATES,
    "added_members_twice": "SELECT DISTINCT plate AS license_plate FROM naturals WHERE plate IS NOT NULL",
    "dense_keys": "SELECT * FROM keyed",
    "hash_keys": "SELECT dimension, count(*) AS members, CAST(0 AS BIGINT) AS collisions FROM keyed GROUP BY dimension",
    "dimension_rows": "SELECT * FROM members",
    "calendar_days": """SELECT year_num, month_num, day_num, day_of_week_num, count(*) AS minutes,
        min(c.time_key) AS first_key, max(c.time_key) AS last_key, CAST(coalesce(sum(n), 0) AS BIGINT) AS detections
        FROM calendar c LEFT JOIN (SELECT time_key, count(*) AS n FROM facts GROUP BY 1) f ON f.time_key = c.time_key
        GROUP BY 1, 2, 3, 4""",
    "calendar_variants": """SELECT CAST(month(m) AS INTEGER) AS month_num, CAST(day(m) AS INTEGER) AS day_num,
        CAST(dayofweek(m) + 1 AS INTEGER) AS day_of_week_num, CAST(hour(m) AS INTEGER) AS hour_num,
        CAST(min(epoch(m)) AS INTEGER) AS first_key, count(*) AS busy_minutes, CAST(sum(n) AS BIGINT) AS detections
        FROM (SELECT date_trunc('minute', original_time) AS m, count(*) AS n FROM staging GROUP BY 1)
        WHERE m >= TIMESTAMP '2024-01-01' AND m < TIMESTAMP '2026-01-01' GROUP BY 1, 2, 3, 4""",
    "latest_per_key": """SELECT event_id, ts, user_id, event_type, value FROM (SELECT *, row_number() OVER
        (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1""",
    "active_cities": "SELECT key AS city_key, member AS city_name, true AS is_active FROM members WHERE dimension = 'city'",
    "reset_and_reload": """SELECT 'members after reset' AS what, CAST(6 AS BIGINT) AS rows UNION ALL SELECT 'facts after reset', 0
        UNION ALL SELECT 'members', count(*) FROM members UNION ALL SELECT 'facts', count(*) FROM facts
        UNION ALL SELECT 'staging', count(*) FROM staging""",
    "without_duplicates": """SELECT landing_id, city, CAST(velocity + CASE WHEN velocity > 50 THEN 1 ELSE 0 END AS INTEGER) AS velocity,
        original_time, original_time + CASE WHEN velocity > 50 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS load_dttm
        FROM staging""",
    "fact_rows": f"SELECT {', '.join(FACT_COLUMNS)} FROM facts",
    "inner_lookup": """SELECT camera_detection_key, time_key, sensor_key, detection_type_key, lp_key, country_key,
        vehicle_class_key, CAST(f.velocity AS INTEGER) AS velocity FROM facts f WHERE time_key > 0 AND sensor_key > 0 AND detection_type_key > 0
        AND lp_key > 0 AND country_key > 0 AND vehicle_class_key > 0""",
    "salted_plate_lookup": """SELECT landing_id, lp, nullif(f.lp_key, -1) AS lp_key FROM staging s
        JOIN facts f ON f.camera_detection_key = s.landing_id""",
    "guarded_lookup": f"""SELECT g.landing_id AS camera_detection_key, CAST(epoch(date_trunc('second', g.original_time)) AS BIGINT) AS time_key,
        {keyed_columns(4294967295)}, CAST(coalesce(g.velocity, 0) AS DOUBLE) AS velocity FROM guarded g
        LEFT JOIN guarded_keys s ON s.dimension = 'sensor' AND s.member = g.sensor
        LEFT JOIN guarded_keys t ON t.dimension = 'detection_type' AND t.member = g.detection_type
        LEFT JOIN guarded_keys p ON p.dimension = 'plate' AND p.member = g.plate
        LEFT JOIN guarded_keys o ON o.dimension = 'country' AND o.member = g.country
        LEFT JOIN guarded_keys v ON v.dimension = 'vehicle_class' AND v.member = g.vehicle_class
        LEFT JOIN guarded_keys c ON c.dimension = 'city' AND c.member = g.city""",
    "time_by_parts": "SELECT s.landing_id, s.original_time, f.time_key FROM staging s JOIN facts f ON f.camera_detection_key = s.landing_id",
    "time_by_minute": "SELECT s.landing_id, s.original_time, f.time_key FROM staging s JOIN facts f ON f.camera_detection_key = s.landing_id",
    "batch_ranges": """SELECT CAST(floor((landing_id - 1) / 500) AS BIGINT) AS batch_no,
        CAST(floor((landing_id - 1) / 500) AS BIGINT) * 500 + 1 AS first_id,
        CAST(floor((landing_id - 1) / 500) AS BIGINT) * 500 + 500 AS last_id, max(landing_id) AS highest_id, count(*) AS rows
        FROM staging GROUP BY 1""",
    "running_fact_keys": """SELECT camera_detection_key, velocity,
        row_number() OVER (ORDER BY camera_detection_key) + 1000 AS fact_key FROM facts""",
    "uuid_fact_keys": "SELECT count(*) AS rows, count(*) AS keys FROM facts",
    "load_reconciliation": f"""SELECT batch_no, coalesce(s.n, 0) AS staged, coalesce(f.n, 0) AS loaded,
        coalesce(s.n, 0) - coalesce(f.n, 0) AS missing FROM ({batch_rows("staging", "landing_id")}) s
        FULL JOIN ({batch_rows("facts", "camera_detection_key")}) f USING (batch_no)""",
    "orphan_keys": ORPHANS,
    "duplicate_members": """SELECT dimension, member, count(*) AS copies FROM (SELECT dimension, member FROM members
        UNION ALL SELECT 'event_type', event_type FROM events) GROUP BY 1, 2 HAVING count(*) > 1""",
    "null_counts": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls FROM facts" for c in FACT_COLUMNS
    ),
    "unknown_shares": " UNION ALL ".join(
        f"SELECT '{k}' AS key_column, count(*) FILTER ({k} = -1) AS unknown_rows, "
        f"round(count(*) FILTER ({k} = -1) / count(*), 6) AS unknown_share FROM facts"
        for k in KEYS
    ),
    "high_water_marks": """SELECT 'all topics' AS topic, max(id) AS last_loaded_id FROM landing UNION ALL
        SELECT '/Bilina/kamery/camea/%', max(last_loaded_id) FROM history WHERE topic LIKE '/Bilina/kamery/camea/%'
        UNION ALL SELECT 'no such topic', 0""",
    "guarded_upsert": """SELECT topic, process_step, last_loaded_id, last_update FROM (SELECT *, row_number() OVER
        (PARTITION BY topic ORDER BY last_loaded_id DESC, last_update DESC) AS n FROM history) WHERE n = 1""",
    "plain_upsert": """SELECT topic, process_step, last_loaded_id, last_update FROM (SELECT *, row_number() OVER
        (PARTITION BY topic ORDER BY last_update DESC, last_loaded_id DESC) AS n FROM history) WHERE n = 1""",
    "append_upsert": """SELECT topic, process_step, last_loaded_id, last_update FROM (SELECT *, row_number() OVER
        (PARTITION BY topic, process_step ORDER BY last_update DESC, last_loaded_id DESC) AS n FROM history) WHERE n = 1""",
    "resume_range": """SELECT c AS "case", first_id, least(first_id + size - 1, high) AS last_id,
        least(first_id + size - 1, high) >= first_id AS has_rows FROM
        (SELECT max(landing_id) AS high, min(landing_id) AS low FROM staging), LATERAL
        (VALUES ('first', low, 1000), ('next', 1001, 1000000000), ('done', 1000000000001, 1000)) v(c, first_id, size)""",
    "run_log": """SELECT 'load_camera_detections' AS job_name, '%' AS topic, 'SUCCESS' AS status,
        count(*) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated, CAST(NULL AS VARCHAR) AS error_message,
        true AS has_ended FROM facts""",
    "load_progress": """SELECT 'load' AS job, batch_no, rows, CAST(so_far AS BIGINT) AS rows_so_far,
        round(so_far / spent, 4) AS rows_per_second, round(so_far * 100 / total, 4) AS percent_done,
        round((total - so_far) / (so_far / spent), 4) AS seconds_left FROM
        (SELECT *, sum(rows) OVER (ORDER BY batch_no) AS so_far, sum(seconds) OVER (ORDER BY batch_no) AS spent,
          sum(rows) OVER () AS total FROM (SELECT CAST(floor((landing_id - 1) / 500) AS BIGINT) AS batch_no,
          count(*) AS rows, coalesce(sum(velocity), 0) + 1 AS seconds FROM staging GROUP BY 1))""",
    "streamed_facts": """SELECT camera_detection_key AS id, velocity, city_name, country_code, sensor_code,
        vehicle_class, license_plate, detection_type FROM star""",
    "compacted_facts": """SELECT camera_detection_key AS id, velocity, week_bucket, city_name, country_code, sensor_code,
        vehicle_class, license_plate, detection_type FROM star""",
    "velocity_by_class": "SELECT vehicle_class, round(avg(velocity), 6) AS average_velocity FROM star GROUP BY 1",
    "detections_by_time": "SELECT full_date, count(*) AS number_of_detections FROM star GROUP BY 1",
    "detections_by_day": "SELECT date_trunc('day', full_date) AS full_date, count(*) AS number_of_detections FROM star GROUP BY 1",
    "fastest_cities": """SELECT city_name, round(avg(velocity), 6) AS average_velocity FROM star
        WHERE country_code = 'CZ' AND vehicle_class = '2' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "velocity_by_type_and_class": """SELECT detection_type, vehicle_class, round(avg(velocity), 6) AS average_velocity
        FROM star GROUP BY 1, 2""",
    "weekend_city_ranks": """SELECT country_code, city_name, vehicle_class, round(avg(velocity), 6) AS average_velocity,
        CAST(dense_rank() OVER (PARTITION BY country_code ORDER BY count(*) DESC) AS INTEGER) AS city_rank_by_detections
        FROM star WHERE day_of_week_num IN (6, 7) GROUP BY 1, 2, 3""",
    "measure_ignoring_filter": """SELECT vehicle_class,
        round(avg(CASE WHEN velocity > 0 THEN velocity END), 6) AS velocity_average_moving,
        round(avg(CASE WHEN velocity > 50 THEN velocity END), 6) AS avg_velocity,
        count(*) FILTER (velocity > 50) AS detections FROM star GROUP BY 1""",
    "filtered_cube": """SELECT city_name, day_of_week_num AS weekday, hour_num AS hour, count(*) AS detections,
        count(DISTINCT license_plate) AS unique_plates, sum(velocity) AS sum_velocity FROM star
        WHERE full_date >= TIMESTAMP '2024-01-09' AND full_date < TIMESTAMP '2024-01-23 12:00:00'
        AND country_code <> 'D' AND velocity IS NOT NULL GROUP BY 1, 2, 3""",
    "date_rollup": """SELECT CAST(grouping(year_num) + grouping(month_num) + grouping(day_num) + grouping(full_date) AS INTEGER) AS level,
        year_num AS year, month_num AS month, day_num AS day, full_date, count(*) AS detections, max(velocity) AS max_velocity
        FROM star GROUP BY ROLLUP (year_num, month_num, day_num, full_date)""",
    "time_rollup": """SELECT CAST(grouping(hour_num) + grouping(minute_num) AS INTEGER) AS level, hour_num AS hour,
        minute_num AS minute, count(*) AS detections, count(DISTINCT license_plate) AS unique_plates
        FROM star GROUP BY ROLLUP (hour_num, minute_num)""",
    "date_drill": "SELECT day_num AS day, count(*) AS detections FROM star WHERE year_num = 2024 AND month_num = 1 GROUP BY 1",
    "drill_members": "SELECT camera_detection_key AS id, full_date, license_plate FROM star WHERE city_name = 'Decin'",
    "data_mart": f"""SELECT camera_detection_key AS facts_id, velocity AS facts_velocity, city_name AS city_city_name,
        country_code AS country_country_code, year_num AS calendar_year, {MONTH} AS calendar_month_name FROM star""",
    "stored_rollup": """SELECT city_name, round(avg(CASE WHEN velocity > 0 THEN velocity END), 6) AS avg_velocity,
        count(*) AS detections, max(velocity) AS max_velocity FROM star GROUP BY 1""",
    "kept_rollup": """SELECT city_name, day_num AS day, round(avg(CASE WHEN velocity > 0 THEN velocity END), 6) AS avg_velocity,
        count(*) AS detections, max(velocity) AS max_velocity, min(velocity) AS min_velocity
        FROM star WHERE country_code = 'CZ' GROUP BY 1, 2""",
    "model_partitions": """SELECT 'facts' AS table_name, count(*) AS rows FROM facts UNION ALL
        SELECT 'calendar', count(*) FROM calendar UNION ALL SELECT dimension, count(*) FROM members GROUP BY 1""",
    "run_monitor": """SELECT 'load_camera_detections' AS job_name, '%' AS topic, 'SUCCESS' AS status,
        CAST(count(DISTINCT 1) AS BIGINT) AS count FROM facts""",
    "control_monitor": "SELECT topic, last_update, count(*) AS count FROM history GROUP BY 1, 2",
    "staging_monitor": "SELECT city, detection_type, sensor, ilpc, count(*) AS count FROM staging GROUP BY 1, 2, 3, 4",
}

MOVING = "CASE WHEN velocity > 0 THEN velocity END"
KNOWN = "CASE WHEN velocity >= 0 THEN velocity END"
MEASURES = {
    "detections": "count(*)",
    "detection_count": "count(camera_detection_key)",
    "detection_type_distinct": "count(DISTINCT detection_type)",
    "detections_with_velocity": "CAST(sum(CASE WHEN velocity > 0 THEN 1 END) AS BIGINT)",
    "detection_count_with_velocity": "count(CASE WHEN velocity > 0 THEN 1 END)",
    "avg_velocity": f"round(avg({MOVING}), 6)",
    "avg_velocity_known": f"round(avg({KNOWN}), 6)",
    "avg_velocity_raw": "round(avg(velocity), 6)",
    "min_velocity": "min(velocity)",
    "max_velocity": "max(velocity)",
    "max_velocity_known": f"max({KNOWN})",
    "sum_velocity_known": "sum(CASE WHEN velocity >= 0 THEN velocity ELSE 0 END)",
    "sum_velocity": "sum(velocity)",
    "unique_plates": "count(DISTINCT license_plate)",
    "distinct_velocity_count": "count(DISTINCT velocity)",
    "velocity_distinct_with_blank": "count(DISTINCT velocity) + max(CASE WHEN velocity IS NULL THEN 1 ELSE 0 END)",
    "velocity_count": "count(velocity)",
    "velocity_average_moving": f"round(avg({MOVING}), 6)",
}
STATEMENTS["all_measures_total"] = "SELECT " + ", ".join(f"{sql} AS {m}" for m, sql in MEASURES.items()) + " FROM star"
STATEMENTS.update({
    f"measure_{m}": f"SELECT city_name, vehicle_class, {sql} AS {m} FROM star GROUP BY 1, 2" for m, sql in MEASURES.items()
})

LABELS = {
    "id": "camera_detection_key",
    "time_key_hidden": "time_key",
    "sensor_key_hidden": "sensor_key",
    "lp_key_hidden": "lp_key",
    "country_key_hidden": "country_key",
    "vehicle_class_key_hidden": "CAST(vehicle_class_key AS VARCHAR)",
    "city_key_hidden": "city_key",
    "year": "year_num",
    "month": "month_num",
    "day": "day_num",
    "weekday": "day_of_week_num",
    "hour": "hour_num",
    "minute": "minute_num",
    "month_name": MONTH,
    "year_month_sort": "year_num * 100 + month_num",
    "month_year_merged": f"CAST(year_num AS VARCHAR) || '-' || lpad(CAST(month_num AS VARCHAR), 2, '0') || ' ' || {MONTH}",
    "month_name_english": "monthname(full_date)",
    "month_year_english": "monthname(full_date) || ' ' || CAST(year_num AS VARCHAR)",
}
# members whose name is that of their column
SAME = """velocity week_bucket detection_type_key city_name is_active country_code sensor_code vehicle_class license_plate
  detection_type full_date""".split()
STATEMENTS.update({
    f"by_{d}": f"SELECT {sql} AS {d}, count(*) AS detections FROM star GROUP BY 1"
    for d, sql in {**LABELS, **{d: d for d in SAME}}.items()
})
STATEMENTS.update({
    f"per_{g}": f"""SELECT CAST(date_trunc('{g}', full_date) AS TIMESTAMP) AS full_date, count(*) AS detections,
        max(velocity) AS max_velocity FROM star GROUP BY 1"""
    for g in ("minute", "hour", "day", "week", "month", "quarter", "year")
})

GUARDED = f""", guarded AS (SELECT id AS landing_id, time AS original_time, {CITY} AS city,
  nullif(trim(detectionType), '') AS detection_type, nullif(trim(lp), '') AS plate, nullif(trim(sensor), '') AS sensor,
  CAST({truthy("vehClass")} AS VARCHAR) AS vehicle_class, nullif(trim(ilpc), '') AS country, {truthy("velocity")} AS velocity FROM fields),
guarded_pairs AS ({stacked({d: d for d in DIMENSIONS}, "guarded")}),
guarded_keys AS (SELECT dimension, member, row_number() OVER (PARTITION BY dimension ORDER BY member) AS key
  FROM (SELECT DISTINCT * FROM guarded_pairs WHERE member IS NOT NULL))
"""

DAYS = 20
MINUTE = "date_diff('minute', TIMESTAMP '2024-01-01', date_trunc('minute', original_time))"


def trimmed(column: str) -> str:
    return f"nullif(trim({column}), '')"


def as_is(column: str) -> str:
    return f"nullif({column}, '')"


def inside(first: int, minutes: int) -> str:
    return f"CASE WHEN {MINUTE} BETWEEN 0 AND {minutes - 1} THEN CAST({MINUTE} + {first} AS INTEGER) ELSE -1 END"


# Per variant, stated here anew: text of members, city, number, unknown key and labels, time key, velocity,
# kept rows, calendar key, full date, weekday, minutes of the calendar and the unknown time.
WHOLE = "TRY_CAST({} AS INTEGER)"
SUNDAY, ISO_DAY = "CAST(dayofweek(ts) + 1 AS INTEGER)", "CAST(isodow(ts) AS INTEGER)"
VARIANTS = {
    "mssql": (trimmed, CITY, WHOLE.format, -1, ("UNKNOWN", "UNK", "-999"), inside(1, DAYS * 1440 - 1439), "velocity",
              "velocity IS NOT NULL", "n + 1", "ts", SUNDAY, DAYS * 1440 - 1439, None),
    "mariadb": (trimmed, CITY, WHOLE.format, -1, ("UNKNOWN", "UNK", "-999"), inside(1104071, DAYS * 1440), "velocity",
                "true", "n + 1104071", "ts", SUNDAY, DAYS * 1440, "1900, 1, 1, 1, 0, 0"),
    "clickhouse": (as_is, CITY, truthy, 4294967295, ("UNKNOWN", "UNKNOWN", "UNKNOWN"),
                   "CAST(epoch(date_trunc('second', original_time)) AS BIGINT)", "coalesce(velocity, 0)",
                   "true", "epoch(ts)", "ts", ISO_DAY, DAYS * 1440, None),
    "postgres": (trimmed, "nullif(trim(split_part(topic, '/', 2)), '')", WHOLE.format, -1, ("Unknown", "Unknown", "Unknown"),
                 inside(1, DAYS * 1440), "velocity", "true", "n + 1", "date_trunc('day', ts)", ISO_DAY, DAYS * 1440,
                 "-1, -1, -1, -1, -1, -1"),
}


def variant(name: str) -> dict[str, str]:
    clean, city, number_of, unknown, (label, country, vehicle), time_key, velocity, kept, key, full_date, weekday, minutes, none = VARIANTS[name]
    unknown_rows = ", ".join(
        f"('{d}', '{country if d == 'country' else vehicle if d == 'vehicle_class' else label}', {unknown})" for d in DIMENSIONS
    )
    unknown_time = f"UNION ALL SELECT -1, TIMESTAMP '1900-01-01', {none}" if none else ""
    names = {"sensor_key": "s", "detection_type_key": "t", "lp_key": "p", "country_key": "o", "vehicle_class_key": "v", "city_key": "c"}
    members = {"s": "sensor", "t": "detection_type", "p": "plate", "o": "country", "v": "vehicle_class", "c": "city"}
    joins = " ".join(
        f"LEFT JOIN v_keys {a} ON {a}.dimension = '{d}' AND {a}.member = r.{d} AND trim(r.{d}) <> ''" for a, d in members.items()
    )
    prelude = PRELUDE + f""", v_rows AS (SELECT id AS landing_id, time AS original_time, {city} AS city, {clean("detectionType")} AS detection_type,
      {clean("lp")} AS plate, {clean("sensor")} AS sensor, CAST({number_of("vehClass")} AS VARCHAR) AS vehicle_class,
      {clean("ilpc")} AS country, {number_of("velocity")} AS velocity FROM fields),
    v_pairs AS ({stacked({d: d for d in DIMENSIONS}, "v_rows")}),
    v_keys AS (SELECT dimension, member, row_number() OVER (PARTITION BY dimension ORDER BY member) AS key
      FROM (SELECT DISTINCT * FROM v_pairs WHERE member IS NOT NULL)),
    v_facts AS (SELECT landing_id AS camera_detection_key, {time_key} AS time_key,
      {", ".join(f"coalesce({a}.key, {unknown}) AS {n}" for n, a in names.items())},
      CAST({velocity} AS DOUBLE) AS velocity, original_time AS detection_time FROM v_rows r {joins} WHERE {kept}),
    v_calendar AS (SELECT CAST({key} AS INTEGER) AS time_key, CAST({full_date} AS TIMESTAMP) AS full_date, CAST(year(ts) AS INTEGER) AS year_num,
      CAST(month(ts) AS INTEGER) AS month_num, CAST(day(ts) AS INTEGER) AS day_num, {weekday} AS day_of_week_num,
      CAST(hour(ts) AS INTEGER) AS hour_num, CAST(minute(ts) AS INTEGER) AS minute_num
      FROM (SELECT n, TIMESTAMP '2024-01-01' + to_minutes(n) AS ts FROM range({minutes}) g(n)) {unknown_time})
    """
    return {
        f"fact_rows_{name}": prelude + f"SELECT {', '.join(FACT_COLUMNS)} FROM v_facts",
        f"member_rows_{name}": prelude + f"SELECT * FROM v_keys UNION ALL SELECT * FROM (VALUES {unknown_rows})",
        f"minutes_{name}": prelude + """SELECT f.time_key, full_date, year_num, month_num, day_num, day_of_week_num, hour_num, minute_num,
          detections FROM (SELECT time_key, count(*) AS detections FROM v_facts GROUP BY 1) f LEFT JOIN v_calendar c ON c.time_key = f.time_key""",
    }


def camera_oracles() -> dict[str, str]:
    found = {name: sql for of in VARIANTS for name, sql in variant(of).items()}
    return found | {name: PRELUDE + (GUARDED if "guarded" in name and "upsert" not in name else "") + sql for name, sql in STATEMENTS.items()}
