"""DuckDB-side derivations of the sensor fixtures (the SQL twins of ``sources.fixtures``).

Every oracle query starts with ``WITH`` + the CTEs it needs.  Double literals are written as
``::DOUBLE`` because DuckDB reads ``0.7`` as DECIMAL.
"""

READINGS = """readings AS (
  SELECT event_id AS row_id, user_id AS entity_id, ts,
         value AS temperature,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) / 10 AS vibration,
         90 + CAST((event_id * 37) % 200 AS DOUBLE) / 10 AS pressure,
         CASE WHEN event_type = 'error' AND value > 200 THEN 1 ELSE 0 END AS failure
  FROM events)"""

HOURLY = """hourly AS (
  SELECT date_trunc('hour', ts) AS ts, avg(temperature) AS temperature, avg(vibration) AS vibration,
         avg(pressure) AS pressure, max(failure) AS failure
  FROM readings GROUP BY 1)"""

HOURLY_GAPS = """hourly_gaps AS (
  SELECT date_trunc('hour', ts) AS ts,
         avg(temperature) FILTER (WHERE entity_id % 10 = 0) AS temperature,
         avg(vibration) FILTER (WHERE entity_id % 10 = 1) AS vibration,
         avg(pressure) FILTER (WHERE entity_id % 10 = 2) AS pressure,
         max(failure) AS failure
  FROM readings GROUP BY 1)"""


def scored_cte(name: str = "scored", w_temp: str = "0.7", w_vib: str = "0.03") -> str:
    return f"""{name} AS (
  SELECT row_id, ts, failure AS label,
         floor(({w_temp}::DOUBLE * temperature / (temperature + 50::DOUBLE) + {w_vib}::DOUBLE * vibration)
               * 10000::DOUBLE) / 10000::DOUBLE AS score
  FROM readings)"""


SCORED = scored_cte()
SCORED_SECOND = scored_cte("scored_second", "0.4", "0.06")


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
