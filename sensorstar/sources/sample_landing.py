"""Landing messages derived from the shared test tables.

The texts are plain SQL that another engine reads the same way, so results can
be compared from the raw payload on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CAMERA_COLUMNS = {
    "id": "event_id + 1",
    "time": "ts",
    "topic": """
  CASE WHEN user_id % 10 = 0 THEN 'nocity'
       WHEN user_id % 3 = 0 THEN '/Bilina/kamery/camea/' || CAST(user_id % 4 AS STRING)
       WHEN user_id % 3 = 1 THEN '/Decin/kamery/camea/'  || CAST(user_id % 4 AS STRING)
       ELSE '/Usti/kamery/camea/' || CAST(user_id % 4 AS STRING) END""",
    "payload": """
  CASE WHEN event_id % 97 = 0 THEN '{"detectionType":"' || event_type
  ELSE '{"detectionType":"' || event_type || '","utc":"' || CAST(ts AS STRING)
    || '","lp":"' || CASE WHEN event_id % 13 = 0 THEN '' ELSE 'LP' || CAST(user_id AS STRING) END
    || '","sensor":" S' || CAST(user_id % 7 AS STRING) || ' ","vehClass":'
    || CASE WHEN event_id % 11 = 0 THEN 'null'
            WHEN event_id % 2 = 0 THEN '"' || CAST(user_id % 5 AS STRING) || '"'
            ELSE CAST(user_id % 5 AS STRING) END
    || ',"ilpc":"' || CASE WHEN user_id % 5 = 0 THEN 'D' ELSE 'CZ' END
    || '","velocity":' || CAST(CAST(floor(value) AS INT) % 130 AS STRING) || '}' END""",
}

# Messages of many shapes: nested objects, lists, quoted JSON, single quotes,
# plain text, mixed value types and truncated objects.
SENSOR_COLUMNS = {
    "id": "o_orderkey + 1",
    "time": "o_orderdate",
    "topic": """
  CASE o_custkey % 8
    WHEN 0 THEN '/Energo/DCUK/meter-' || CAST(o_custkey % 3 AS STRING) || '/act'
    WHEN 1 THEN '/Energo/DCUK/meter-' || CAST(o_custkey % 3 AS STRING)
    WHEN 2 THEN '/Energo/DCUK/meter:' || CAST(o_custkey % 3 AS STRING) || '/har'
    WHEN 3 THEN '/ttndata/voda/eui.' || CAST(o_custkey % 5 AS STRING)
    WHEN 4 THEN '/voda/KA-' || CAST(o_custkey % 7 AS STRING)
    WHEN 5 THEN '/udp1881/' || CAST(o_custkey % 9 AS STRING)
    WHEN 6 THEN '/cez/mve/decin/' || CAST(o_custkey % 2 AS STRING)
    ELSE 'status' END""",
    "payload": """
  CASE WHEN o_orderkey % 53 = 0 THEN '{"V":{"L1":' || CAST(o_orderkey AS STRING)
  ELSE CASE o_custkey % 8
    WHEN 0 THEN '{"V":{"L1":' || CAST(o_orderkey % 240 AS STRING) || '.5,"L2":' || CAST(o_orderkey % 7 AS STRING)
      || '},"I":[' || CAST(o_orderkey % 3 AS STRING) || ',{"x-Phase":"p' || CAST(o_orderkey % 3 AS STRING)
      || '"}],"ok":' || CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END
      || ',"at":"2024-01-0' || CAST(o_orderkey % 9 + 1 AS STRING) || 'T03:04:05Z","none":{},"gap":[]}'
    WHEN 1 THEN '[{"V":{"L1":' || CAST(o_orderkey % 240 AS STRING) || '.25},"at":"2024-02-0'
      || CAST(o_orderkey % 9 + 1 AS STRING) || '"}]'
    WHEN 2 THEN '{''har'':{''h3'':' || CAST(o_orderkey % 50 AS STRING) || '},''osc'':''n''}'
    WHEN 3 THEN '{"uplink":"{''rssi'':-' || CAST(o_orderkey % 90 AS STRING) || ',''sf'':7}","data":"[1,'
      || CAST(o_orderkey % 5 AS STRING) || ']","note":"{broken}"}'
    WHEN 4 THEN CASE WHEN o_orderkey % 5 = 0 THEN '{"level":"3f not retrieved","battery":"3.6","state":null}'
      WHEN o_orderkey % 5 = 1 THEN '{"level":12.5,"battery":3,"extra":"e' || CAST(o_orderkey % 4 AS STRING) || '"}'
      ELSE '{"level":' || CAST(o_orderkey % 100 AS STRING) || ',"battery":"' || CAST(o_orderkey % 4 AS STRING) || '.5"}' END
    WHEN 5 THEN '[{"a":' || CAST(o_orderkey % 10 AS STRING) || '},{"a":2,"b":"x' || CAST(o_orderkey % 3 AS STRING) || '"}]'
    WHEN 6 THEN '{"flow":' || CASE WHEN o_orderkey % 11 = 0 THEN CAST(9007199254740993 + 2 * o_orderkey AS STRING)
      WHEN o_orderkey % 13 = 0 THEN '"n/a"' ELSE CAST(o_orderkey % 1000 AS STRING) END || ',"unit":"m3","level":1}'
    ELSE 'offline ' || CAST(o_orderkey % 6 AS STRING) END END""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def camera_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "events"), CAMERA_COLUMNS)


def sensor_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "orders"), SENSOR_COLUMNS)


def _project(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    return rows.selectExpr(*[f"{text} AS {name}" for name, text in columns.items()])


def as_sql(columns: dict[str, str], source: str) -> str:
    """The same landing as one SELECT."""
    return "SELECT " + ", ".join(f"{text} AS {name}" for name, text in columns.items()) + f" FROM {source}"
