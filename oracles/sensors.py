"""SQL for the queries on payloads of many shapes and on latencies."""

from __future__ import annotations

from sensorstar.plans.registered_sensors import FIRST_STEP, FUSED, GROUPS, LAST_GROUP, NARROW
from sensorstar.sources.sample_landing import SENSOR_COLUMNS, as_sql

QUOTE = "''''"


def swapped(text: str) -> str:
    return f"replace({text}, {QUOTE}, '\"')"


def looks(text: str) -> str:
    return f"({text} LIKE '{{%}}' OR {text} LIKE '[%]')"


def name(path: str) -> str:
    squeezed = f"trim(regexp_replace(lower({path}), '[^a-z0-9]+', '_', 'g'), '_')"
    return f"CASE WHEN {squeezed} = '' OR regexp_matches({squeezed}, '^[0-9]') THEN 'col_' || {squeezed} ELSE {squeezed} END"


def logical(depth: int) -> str:
    return f"'/' || array_to_string(list_filter(string_split(topic, '/'), lambda p: p <> '')[1:{depth}], '/')"


# digits alone are read exactly, other numbers are rounded to even
WHOLE = """CASE WHEN regexp_matches(t.text, '^[+-]?[0-9]+$') THEN TRY_CAST(t.text AS BIGINT)
  ELSE TRY_CAST(round_even(TRY_CAST(t.text AS DOUBLE), 0) AS BIGINT) END"""

# the texts that count as times: dates of the calendar or of weeks, with or without a time of day
DATE = "[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])|[0-9]{4}-?W(0[1-9]|[1-4][0-9]|5[0-3])(-?[1-7])?|[0-9]{4}(0[1-9]|1[0-2])(0[1-9]|[12][0-9]|3[01])"
CLOCK = "([01][0-9]|2[0-3])(:?[0-5][0-9](:?[0-5][0-9]([.,][0-9]+)?)?)?(Z|[+-][0-9]{2}(:?[0-9]{2}(:?[0-9]{2}([.][0-9]+)?)?)?)?"
ISO = f"^({DATE})(.{CLOCK})?$"
# parts of topics that name a table
TABLE_KEYWORDS = "energo|dcuk|camea|ttndata|bilina|cez|decin|mve"
PRELUDE = f"""WITH landing AS ({as_sql(SENSOR_COLUMNS, "orders")}),
read AS (SELECT id, time, topic, payload, CASE WHEN json_valid(payload) THEN CAST(payload AS JSON)
  WHEN payload LIKE '{{%' AND contains(payload, {QUOTE}) AND NOT contains(payload, '"') AND json_valid({swapped("payload")})
    THEN CAST({swapped("payload")} AS JSON)
  ELSE json_object('raw_value', payload) END AS j0 FROM landing),
parsed AS (SELECT id, time, topic, payload, CASE WHEN json_type(j0) = 'ARRAY' AND json_array_length(j0) = 1
  AND json_type(j0, '$[0]') = 'OBJECT' THEN j0->'$[0]' ELSE j0 END AS j FROM read),
outer_leaves AS (SELECT parsed.id, parsed.time, parsed.topic, t.fullkey AS key, t.type, t.atom, t.atom->>'$' AS text
  FROM parsed, json_tree(parsed.j) t WHERE t.type NOT IN ('OBJECT', 'ARRAY')),
marked AS (SELECT *, coalesce(type = 'VARCHAR' AND {looks("text")} AND json_valid({swapped("text")}), false) AS quoted FROM outer_leaves),
all_leaves AS (SELECT id, time, topic, key, type, text FROM marked WHERE NOT quoted UNION ALL
  SELECT q.id, q.time, q.topic, q.key || substr(t.fullkey, 2), t.type, t.atom->>'$'
  FROM (SELECT *, CAST({swapped("text")} AS JSON) AS inner_json FROM marked WHERE quoted) q, json_tree(q.inner_json) t
  WHERE t.type NOT IN ('OBJECT', 'ARRAY')),
leaves AS (SELECT id, time, topic, {name("substr(key, 2)")} AS path, type, nullif(text, 'null') AS text FROM all_leaves),
typed AS (SELECT *, {logical(1)} AS "group", CASE WHEN type = 'BOOLEAN' THEN 'BOOLEAN' WHEN type IN ('BIGINT', 'UBIGINT') THEN 'BIGINT'
  WHEN type = 'DOUBLE' THEN 'DOUBLE PRECISION' WHEN type = 'VARCHAR' AND regexp_matches(text, '{ISO}') THEN 'TIMESTAMPTZ'
  WHEN type = 'VARCHAR' AND regexp_matches(text, '^([0-9]+[.]?[0-9]*|[.][0-9]+)$') THEN 'DOUBLE PRECISION' ELSE 'TEXT' END AS kind
  FROM leaves),
grouped AS (SELECT "group", path, arg_min(kind, id) AS type, min(id) AS first_seen_id FROM typed GROUP BY 1, 2),
conformed AS (SELECT t.id, t.topic, t.path, g.type, g.type IN ('BIGINT', 'DOUBLE PRECISION') AS numeric_column, t.text,
  CASE WHEN g.type = 'BIGINT' THEN {WHOLE} END AS whole,
  CASE WHEN g.type = 'DOUBLE PRECISION' THEN TRY_CAST(t.text AS DOUBLE) END AS number
  FROM typed t JOIN grouped g ON g."group" = t."group" AND g.path = t.path),
elements AS (SELECT id, CAST(0 AS INTEGER) AS element, CASE WHEN json_valid(payload) THEN CAST(payload AS JSON)
    ELSE json_object('value', payload) END AS j FROM landing WHERE NOT coalesce(payload LIKE '[%' AND json_valid(payload), false)
  UNION ALL SELECT p.id, CAST(t.key AS INTEGER), t.value FROM (SELECT id, CAST(payload AS JSON) AS j FROM landing
    WHERE payload LIKE '[%' AND json_valid(payload)) p, json_each(p.j) t),
nodes AS (SELECT elements.id, element, t.fullkey AS key, t.type, t.value, t.atom->>'$' AS text FROM elements, json_tree(elements.j) t),
latest AS (SELECT topic, arg_max(payload, id) AS payload FROM landing GROUP BY topic),
newest AS (SELECT topic, CASE WHEN json_type(j) = 'ARRAY' AND json_array_length(j) > 0 THEN j->'$[0]' ELSE j END AS j
  FROM (SELECT topic, CAST(payload AS JSON) AS j FROM latest WHERE json_valid(payload))),
newest_nodes AS (SELECT topic, t.fullkey AS key, t.type, t.value, t.atom->>'$' AS text FROM newest, json_tree(newest.j) t),
"""

FIRST_ONLY = "NOT regexp_matches(key, '\\[[1-9][0-9]*\\]')"
# a list whose first element is no container stays whole
WHOLE_LIST = "type = 'ARRAY' AND coalesce(json_type(value, '$[0]'), '') NOT IN ('OBJECT', 'ARRAY')"
LEGACY = """lower(trim(translate(replace(replace(replace(key, '[0]', '.array'), '"', ''), '$', ''), '.-', '__'), '_'))"""


def first_leaves(source: str, keep: str) -> str:
    return f"""SELECT {keep}, CASE WHEN {LEGACY} = '' THEN CASE WHEN type = 'ARRAY' THEN 'array' ELSE 'value' END ELSE {LEGACY} END AS path,
      CASE WHEN type = 'ARRAY' THEN CAST(value AS VARCHAR) ELSE text END AS text FROM {source}
      WHERE {FIRST_ONLY} AND (({WHOLE_LIST}) OR (type NOT IN ('OBJECT', 'ARRAY') AND NOT regexp_matches(key, '\\]$')))"""


SIGNED = "replace(regexp_replace(regexp_replace(substr({key}, 2), '\\.(\"[^\"]+\"|[^.\\[]+)', '\\1:object_', 'g'), '\\[0\\]', 'array:', 'g'), '\"', '')"
CLEAN = "translate(lower({text}), '-.', '__')"


def without_last(text: str) -> str:
    return f"coalesce(nullif(left({text}, greatest(len({text}) - 1, 0)), ''), 'value')"


OUTER_NAME = SIGNED.format(key="key")
INNER_NAME = SIGNED.format(key="t.fullkey")
STRUCTURES = f"""outer_names AS (SELECT topic, {OUTER_NAME} AS n, type, text,
    coalesce(type = 'VARCHAR' AND {looks("text")}, false) AS suspect,
    CASE WHEN text LIKE '{{%' AND contains(text, {QUOTE}) AND NOT contains(text, '"') THEN {swapped("text")} ELSE text END AS fixed
  FROM newest_nodes WHERE type NOT IN ('OBJECT', 'ARRAY') AND {FIRST_ONLY}),
signatures AS (SELECT DISTINCT topic, {CLEAN.format(text="k")} AS key FROM (
  SELECT topic, {without_last("n")} || ':value' AS k FROM outer_names WHERE NOT suspect
  UNION ALL SELECT topic, {without_last("n")} || ':scalar' FROM outer_names WHERE suspect AND NOT json_valid(fixed)
  UNION ALL SELECT topic, {without_last("n || 'subjson:object_' || " + INNER_NAME)} || ':value'
  FROM (SELECT *, CAST(fixed AS JSON) AS inner_json FROM outer_names WHERE suspect AND json_valid(fixed)) s, json_tree(s.inner_json) t
  WHERE t.type NOT IN ('OBJECT', 'ARRAY') AND NOT regexp_matches(t.fullkey, '\\[[1-9][0-9]*\\]'))),
structures AS (SELECT topic, list_sort(list(key)) AS keys FROM signatures GROUP BY topic),
reported AS (SELECT row_number() OVER (ORDER BY min(topic)) - 1 AS group_id, count(*) AS num_topics,
  array_to_string(list_sort(list(topic)), ', ') AS topics, array_to_string(keys, ', ') AS keys FROM structures GROUP BY structures.keys)
"""

KEY_SETS = f"""topic_keys AS (SELECT topic, list_sort(list(DISTINCT path)) AS keys FROM ({first_leaves("newest_nodes", "topic")}) GROUP BY topic),
alike AS (SELECT a.topic AS a, b.topic AS b, a.keys AS keys_a, b.keys AS keys_b,
  len(list_intersect(a.keys, b.keys)) / len(list_distinct(a.keys || b.keys)) AS similarity
  FROM topic_keys a JOIN topic_keys b ON true)
"""

CLUSTERS = f"""{KEY_SETS}, reach AS (SELECT a AS topic, min(b) AS first_topic FROM (
    WITH RECURSIVE walk(a, b) AS (SELECT a, b FROM alike WHERE similarity >= 0.5 UNION
      SELECT walk.a, s.b FROM walk JOIN alike s ON s.a = walk.b AND s.similarity >= 0.5) SELECT * FROM walk) GROUP BY a)
"""

CALLS = """WITH calls AS (SELECT event_type AS database, CAST([1, 5, 10, 20][user_id % 4 + 1] AS INTEGER) AS concurrency, value AS latency,
  CAST(event_id % 1000 * 60 AS DOUBLE) AS started, event_id % 1000 * 60 + value AS ended FROM events)
"""
TPS = "SELECT database, concurrency, round(count(*) / (max(ended) - min(started)), 2) AS tps FROM calls {where} GROUP BY 1, 2"

MAPPING = ", ".join(
    f"('{'_'.join(str(g) for g in FUSED) if group in FUSED else group}', '{topic}')"
    for group, topics in GROUPS.items()
    for topic in topics
)

# The upper signs of Windows-1250.
CENTRAL = (
    "€‚„…†‡‰Š‹ŚŤŽŹ‘’“”•–—™š›śťžź\u00a0ˇ˘Ł¤Ą¦§¨©Ş«¬\u00ad®Ż°±˛ł´µ¶·¸ąş»Ľ˝ľż"
    "ŔÁÂĂÄĹĆÇČÉĘËĚÍÎĎĐŃŇÓÔŐÖ×ŘŮÚŰÜÝŢßŕáâăäĺćçčéęëěíîďđńňóôőö÷řůúűüýţ˙"
)
DECODED = f"""CASE WHEN doc_id % 3 = 0 THEN text
  WHEN doc_id % 3 = 1 THEN 'čž ' || regexp_replace(text, '[^\\x00-\\x7F{CENTRAL}]', '?', 'g')
  ELSE chr(129) || 'è ' || regexp_replace(text, '[^\\x00-\\xFF]', '?', 'g') END"""

WIDE = f"""SELECT l.id, any_value(l.time) AS time, any_value(l.topic) AS topic,
  max(CASE WHEN path = 'level' THEN whole END) AS level, max(CASE WHEN path = 'battery' THEN number END) AS battery,
  max(CASE WHEN path = 'state' THEN text END) AS state, max(CASE WHEN path = 'extra' THEN text END) AS extra,
  max(CASE WHEN path = 'raw_value' THEN text END) AS raw_value
  FROM landing l JOIN (SELECT t.id, t.path, t.text, {WHOLE} AS whole, TRY_CAST(t.text AS DOUBLE) AS number FROM typed t JOIN
    (SELECT path, arg_min(kind, id) AS type FROM typed WHERE topic LIKE '/voda/%' GROUP BY 1) g ON g.path = t.path) v ON v.id = l.id
  WHERE l.topic LIKE '/voda/%' GROUP BY l.id"""

KEYWORD_PARTS = f"""SELECT first_topic, list(part ORDER BY topic, pos)[1:3] AS core FROM (SELECT r.first_topic, r.topic,
  unnest(string_split(lower(r.topic), '/')) AS part, unnest(range(len(string_split(r.topic, '/')))) AS pos FROM reach r)
  WHERE regexp_matches(part, '{TABLE_KEYWORDS}') GROUP BY 1"""


MAPPED = f"""(VALUES {MAPPING}) m(group_id, topic)"""
LOADED = f"""mapped AS (SELECT m.group_id, t.* FROM typed t JOIN {MAPPED} ON m.topic = t.topic),
columns AS (SELECT group_id, path, arg_min(kind, id) AS type, min(id) AS first_seen_id FROM mapped GROUP BY 1, 2),
cells AS (SELECT l.id, c.group_id, l.topic, c.path, c.type, t.text, CASE WHEN c.type = 'BIGINT' THEN {WHOLE} END AS whole,
  CASE WHEN c.type = 'DOUBLE PRECISION' THEN TRY_CAST(t.text AS DOUBLE) END AS number
  FROM landing l JOIN {MAPPED} ON m.topic = l.topic JOIN columns c ON c.group_id = m.group_id
  LEFT JOIN mapped t ON t.id = l.id AND t.path = c.path)"""


def on_leaves(sql: str) -> str:
    return PRELUDE.rstrip().removesuffix(",") + "\n" + sql


def statements() -> dict[str, str]:
    return {
        "tolerant_payloads": on_leaves(
            """SELECT id, json_type(j) AS kind, CASE WHEN json_type(j) = 'OBJECT'
            THEN array_to_string(list_sort(json_keys(j)), ',') END AS keys FROM parsed"""
        ),
        "decoded_bytes": f"SELECT doc_id, md5({DECODED}) AS digest, CAST(length({DECODED}) AS INTEGER) AS length FROM documents",
        "repaired_text": "SELECT doc_id, md5(text) AS digest FROM documents",
        "column_names": f"""SELECT DISTINCT md5(path) AS source, md5(name) AS digest, CAST(length(name) AS INTEGER) AS length FROM
            (SELECT path, {name("path")} AS name FROM (SELECT url AS path FROM pages UNION ALL SELECT text FROM documents))""",
        "flattened_leaves": on_leaves("SELECT id, path, text FROM leaves"),
        "list_elements": on_leaves(
            """SELECT id, element, CASE WHEN json_type(j) IN ('BIGINT', 'UBIGINT') THEN 'BIGINT' ELSE json_type(j) END AS kind
            FROM elements"""
        ),
        "flattened_by_first_element": on_leaves(f"SELECT * REPLACE (nullif(text, 'null') AS text) FROM ({first_leaves('nodes', 'id, element')})"),
        "flattened_lists_as_text": on_leaves(
            f"""SELECT id, element, CASE WHEN {LEGACY} = '' THEN CASE WHEN type = 'ARRAY' THEN 'array' ELSE 'value' END ELSE {LEGACY} END AS path,
            CASE WHEN type = 'ARRAY' THEN CAST(value AS VARCHAR) ELSE nullif(text, 'null') END AS text FROM nodes
            WHERE type <> 'OBJECT' AND NOT contains(key, '[')"""
        ),
        "column_catalogue": on_leaves(
            """SELECT topic, path, arg_min(kind, id) AS type, min(id) AS first_seen_id, count(*) AS leaves FROM typed GROUP BY 1, 2"""
        ),
        "column_catalogue_plain_text": on_leaves(
            """SELECT topic, path, arg_min(CASE WHEN kind = 'DOUBLE PRECISION' AND type = 'VARCHAR' THEN 'TEXT' ELSE kind END, id) AS type
            FROM typed GROUP BY 1, 2"""
        ),
        "shared_types": on_leaves(
            """SELECT "group", path, count(DISTINCT CASE WHEN type IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN 'number'
            WHEN type <> 'NULL' THEN type END) > 1 AS mixed FROM typed GROUP BY 1, 2"""
        ),
        "added_columns": on_leaves(
            """SELECT "group", path, coalesce(arg_min(kind, id) FILTER (time < TIMESTAMP '1996-01-01'), arg_min(kind, id)) AS type,
            coalesce(min(id) FILTER (time < TIMESTAMP '1996-01-01'), min(id)) AS first_seen_id FROM typed GROUP BY 1, 2"""
        ),
        "batch_columns": on_leaves(
            """SELECT topic, CAST(floor((id - 1) / 1000) AS BIGINT) AS batch_no,
            array_to_string(list_sort(list(DISTINCT path)), ',') AS columns FROM leaves GROUP BY 1, 2"""
        ),
        "wide_staging": on_leaves(WIDE),
        "conformed_values": on_leaves(
            """SELECT id, path, type, whole, number,
            CASE WHEN NOT numeric_column OR (text IS NOT NULL AND coalesce(whole, number) IS NULL) THEN text END AS text,
            numeric_column AND text IS NOT NULL AND coalesce(whole, number) IS NULL AS rejected FROM conformed"""
        ),
        "rejected_values": on_leaves(
            """SELECT id, topic, path, type, text FROM conformed
            WHERE numeric_column AND text IS NOT NULL AND coalesce(whole, number) IS NULL"""
        ),
        "logical_topics": on_leaves(
            f"SELECT {logical(3)} AS logical_topic, count(*) AS messages, count(DISTINCT topic) AS topics FROM landing GROUP BY 1"
        ),
        "topic_tables": on_leaves(
            """SELECT DISTINCT topic, 'stg_' || lower(replace(translate(trim(topic, '/'), '-:./', '____'), '__', '_')) AS table_name
            FROM landing"""
        ),
        "cluster_tables": PRELUDE + CLUSTERS + f""", core AS ({KEYWORD_PARTS})
            SELECT first_topic, cluster_no, 'stg_' || lower(array_to_string(coalesce(core, plain), '_')) AS table_name,
            array_to_string(plain, '/') || '/virt_group_' || CAST(cluster_no AS VARCHAR) AS virtual_topic FROM
            (SELECT first_topic, row_number() OVER (ORDER BY first_topic) - 1 AS cluster_no,
              string_split(trim(first_topic, '/'), '/')[1:2] AS plain FROM (SELECT DISTINCT first_topic FROM reach))
            LEFT JOIN core USING (first_topic)""",
        "topic_groups": on_leaves(
            f"""SELECT group_id, l.topic, count(*) AS messages FROM landing l
            JOIN (VALUES {MAPPING}) m(group_id, topic) ON m.topic = l.topic GROUP BY 1, 2"""
        ),
        "group_results": on_leaves(
            f"""SELECT group_id, count(l.id) AS rows, CASE WHEN count(l.id) > 0 THEN 'SUCCESS' ELSE 'EMPTY' END AS status
            FROM (VALUES {MAPPING}) m(group_id, topic) LEFT JOIN landing l ON m.topic = l.topic GROUP BY 1"""
        ),
        "dynamic_rows": PRELUDE + LOADED + """SELECT group_id, id AS landing_id, topic, path, whole, number,
            CASE WHEN type = 'TIMESTAMPTZ' THEN strftime(CAST(CAST(text AS TIMESTAMPTZ) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S')
              WHEN type NOT IN ('BIGINT', 'DOUBLE PRECISION') THEN text END AS text FROM cells""",
        "dynamic_columns": PRELUDE + LOADED + f"""SELECT group_id, path, type, first_seen_id,
            CASE WHEN first_seen_id <= {FIRST_STEP} OR (SELECT min(m.id) FROM mapped m WHERE m.group_id = c.group_id) > {FIRST_STEP}
              THEN CAST(0 AS INTEGER) ELSE CAST(1 AS INTEGER) END AS load FROM columns c""",
        "dynamic_rejects": PRELUDE + LOADED + """SELECT group_id, id AS landing_id, topic, path, type, text FROM cells
            WHERE type IN ('BIGINT', 'DOUBLE PRECISION') AND text IS NOT NULL AND coalesce(whole, number) IS NULL""",
        "dynamic_results": PRELUDE + LOADED + f"""SELECT 'load_dynamic_staging' AS job_name, group_id,
            CASE WHEN n = 0 THEN 'EMPTY' WHEN width > {NARROW} THEN 'ERROR' ELSE 'SUCCESS' END AS status,
            CASE WHEN width <= {NARROW} THEN n ELSE 0 END AS rows,
            CASE WHEN width > {NARROW} THEN width || ' columns, a table takes {NARROW}' END AS error_message
            FROM (SELECT m.group_id, count(l.id) AS n, (SELECT count(*) FROM columns c WHERE c.group_id = m.group_id) AS width
              FROM {MAPPED} LEFT JOIN landing l ON l.topic = m.topic GROUP BY m.group_id)
            UNION ALL SELECT 'load_dynamic_staging', '{LAST_GROUP}', 'INTERRUPTED', 0, NULL""",
        "structure_signatures": PRELUDE + STRUCTURES + "SELECT topic, array_to_string(keys, ', ') AS keys FROM structures",
        "structure_report": PRELUDE + STRUCTURES + "SELECT * FROM reported",
        "structure_report_file": PRELUDE + STRUCTURES
        + 'SELECT group_id AS "GroupID", num_topics AS "NumTopics", topics AS "Topics", keys AS "Keys" FROM reported',
        "similar_key_sets": PRELUDE + KEY_SETS + """SELECT DISTINCT least(x, y) AS keys_a, greatest(x, y) AS keys_b, round(similarity, 6) AS similarity
            FROM (SELECT array_to_string(keys_a, ', ') AS x, array_to_string(keys_b, ', ') AS y, similarity FROM alike)
            WHERE x <> y AND similarity >= 0.25""",
        "fuzzy_clusters": PRELUDE + CLUSTERS + "SELECT topic, first_topic FROM reach",
        "latency_summary": CALLS + """SELECT database, concurrency, round(avg(latency), 4) AS avg_latency_s, round(min(latency), 4) AS min_latency_s,
            round(max(latency), 4) AS max_latency_s, count(*) AS total_queries,
            round((d[j] * (20 - r) + d[j + 1] * r) / 20, 4) AS p95_latency_s FROM calls JOIN
            (SELECT *, 19 * (n + 1) - 20 * j AS r FROM (SELECT database, concurrency, list_sort(list(latency)) AS d, count(*) AS n,
              greatest(1, least(19 * (count(*) + 1) // 20, count(*) - 1)) AS j FROM calls GROUP BY 1, 2))
            USING (database, concurrency) GROUP BY database, concurrency, d, j, r""",
        "throughput": CALLS + TPS.format(where=""),
        "refreshed_results": CALLS + TPS.format(where="WHERE database NOT IN ('click', 'view')") + """ UNION ALL
            SELECT database, concurrency, round(count(*) / (max(ended) + 100000 - min(started)), 2)
            FROM calls WHERE database IN ('click', 'view') GROUP BY 1, 2""",
        "throughput_pivot": CALLS + "SELECT concurrency, " + ", ".join(
            f"max(tps) FILTER (database = '{d}') AS {d}" for d in ("click", "error", "purchase", "signup", "view")
        ) + f" FROM ({TPS.format(where='')}) GROUP BY 1",
    }


def sensor_oracles() -> dict[str, str]:
    return statements()
