"""Derived ``flights`` and ``weather`` views over the driver's test tables.

No flight data is supplied, so a raw BTS-style flight table is derived
deterministically from ``orders`` x ``customer`` with planted defects (bad
dates, bad airports, bad/null distance, cancellations, diversions, exact
duplicates, HHMM 2400 and minute overflow, tied minutes), and a weather
observation table from ``events``. The same derivation is written once for
Spark and once for DuckDB (the oracle), using integer arithmetic only.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession

_FLIGHTS_BODY = """
SELECT o.o_orderkey AS flight_id,
  CASE WHEN o.o_orderkey % 307 = 5 THEN 'bad-date' ELSE {date_expr} END AS {q}FL_DATE{q},
  CASE substr(o.o_orderpriority, 1, 1) WHEN '1' THEN 'AA' WHEN '2' THEN ' dl' WHEN '3' THEN 'UA'
       WHEN '4' THEN 'WN' ELSE 'B6' END AS {q}OP_UNIQUE_CARRIER{q},
  CASE WHEN o.o_orderkey % 199 = 7 THEN 'XXXX' ELSE concat('A', chr(65 + c.c_nationkey), 'X') END AS {q}ORIGIN{q},
  concat('A', chr(CAST(65 + (o.o_orderkey * 7 + o.o_custkey) % 25 AS INT)), 'X') AS {q}DEST{q},
  CAST(CASE WHEN o.o_orderkey % 97 = 3 THEN 2400
            WHEN o.o_orderkey % 89 = 4 THEN ((o.o_custkey * 5 + o.o_orderkey) % 24) * 100 + 85
            ELSE ((o.o_custkey * 5 + o.o_orderkey) % 24) * 100 + 15 * (o.o_orderkey % 4) END AS INT) AS {q}CRS_DEP_TIME{q},
  CAST((((o.o_custkey * 5 + o.o_orderkey) % 24) * 100 + 15 * (o.o_orderkey % 4) + 200) % 2400 AS INT) AS {q}CRS_ARR_TIME{q},
  CASE WHEN o.o_orderkey % 40 = 0 OR o.o_orderkey % 83 = 1 THEN NULL
       ELSE CAST(CAST(floor(o.o_totalprice) AS BIGINT) % 64 - 30 AS DOUBLE) END AS {q}ARR_DELAY{q},
  CASE WHEN o.o_orderkey % 40 = 0 THEN NULL
       ELSE CAST(CAST(floor(o.o_totalprice) AS BIGINT) % 64 - 33 AS DOUBLE) END AS {q}DEP_DELAY{q},
  CASE WHEN o.o_orderkey % 211 = 8 THEN -50.0E0 WHEN o.o_orderkey % 223 = 9 THEN NULL
       ELSE CAST(200 + (o.o_custkey * 37) % 2600 AS DOUBLE) END AS {q}DISTANCE{q},
  CASE WHEN o.o_orderkey % 40 = 0 THEN 1 ELSE 0 END AS {q}CANCELLED{q},
  CASE WHEN o.o_orderkey % 83 = 1 AND o.o_orderkey % 40 <> 0 THEN 1 ELSE 0 END AS {q}DIVERTED{q}
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""

_SPARK_DATE = ("CAST(date_add(DATE'2024-01-01', CAST(datediff(CAST(o.o_orderdate AS DATE), "
               "DATE'1995-01-01') % 366 AS INT)) AS STRING)")
_DUCK_DATE = ("CAST(DATE '2024-01-01' + CAST(date_diff('day', DATE '1995-01-01', "
              "CAST(o.o_orderdate AS DATE)) % 366 AS INTEGER) AS VARCHAR)")

FLIGHTS_SPARK_SQL = (
    "WITH f AS (" + _FLIGHTS_BODY.format(date_expr=_SPARK_DATE, q="`") + ")\n"
    "SELECT * FROM f UNION ALL SELECT * FROM f WHERE flight_id % 251 = 6")
FLIGHTS_DUCKDB_SQL = (
    "WITH f AS (" + _FLIGHTS_BODY.format(date_expr=_DUCK_DATE, q='"') + ")\n"
    "SELECT * FROM f UNION ALL SELECT * FROM f WHERE flight_id % 251 = 6")

# weather condition text per event type (fixed mapping of the derived view)
_WEATHER_BODY = """
SELECT event_id AS obs_id,
  concat('A', chr(CAST(65 + user_id % 25 AS INT)), 'X') AS airport,
  ts AS {q}timestamp{q},
  value / 10 - 10 AS temperature,
  CAST(event_id % 101 AS DOUBLE) AS humidity,
  CAST(event_id % 45 AS DOUBLE) AS wind_speed,
  CAST(event_id % 361 AS DOUBLE) AS wind_direction,
  CAST(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS DOUBLE) / 10 AS precipitation,
  CAST(event_id % 11 AS DOUBLE) AS visibility,
  CAST(1013 AS DOUBLE) AS pressure,
  CAST(event_id % 10 AS DOUBLE) / 10 AS cloud_cover,
  CASE event_type WHEN 'signup' THEN 'rain' WHEN 'view' THEN 'snow' WHEN 'click' THEN 'fog'
       WHEN 'error' THEN 'thunderstorm' ELSE 'clear' END AS weather_condition
FROM events
"""
WEATHER_SPARK_SQL = _WEATHER_BODY.format(q="`")
WEATHER_DUCKDB_SQL = _WEATHER_BODY.format(q='"')

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register(spark: SparkSession, sf_dir: str, names: list[str]) -> None:
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


def raw_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw BTS-shaped flight records (upper-case headers, defects planted)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice",
                                              "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # session-scoped views with unique names so concurrent sf dirs don't collide
    tag = zlib.crc32(sf_dir.encode())
    o.createOrReplaceTempView(f"orders_{tag}")
    c.createOrReplaceTempView(f"customer_{tag}")
    sql = (FLIGHTS_SPARK_SQL.replace("FROM orders o", f"FROM orders_{tag} o")
           .replace("JOIN customer c", f"JOIN customer_{tag} c"))
    return spark.sql(sql)


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    tag = zlib.crc32(sf_dir.encode())
    ev.createOrReplaceTempView(f"events_{tag}")
    return spark.sql(WEATHER_SPARK_SQL.replace("FROM events", f"FROM events_{tag}"))
