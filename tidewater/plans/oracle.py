"""DuckDB SQL building blocks for the correctness oracle.

The oracle derives the same report fields from ``events`` with the fixture
expressions (``sources.fixture``), without going through JSON: what Spark
decodes from the JSON text must equal what the derivation put there.
"""

from __future__ import annotations

from ..sources import fixture

SAR = "StandardSearchAndRescueAircraftReport"
POSITION_TYPES_SQL = "('PositionReport', 'ExtendedClassBPositionReport', 'StandardClassBPositionReport')"

REPORTS_CTE = f"""
reports AS (
  SELECT 'raw' AS topic, CAST(event_id % 3 AS INTEGER) AS "partition",
         event_id // 3 AS "offset", 0 AS pos, arrival_ts, obj AS value, event_id,
         mtype AS MessageType, mmsi AS MMSI, mmsi AS MMSI_String, ship AS ShipName,
         CAST(lat_t AS DOUBLE) AS latitude, CAST(lng_t AS DOUBLE) AS longitude,
         time_text AS time_utc,
         CASE WHEN event_id % 17 <> 0 THEN CAST(event_id * 37 % 361 AS DOUBLE) END AS Cog,
         CASE WHEN event_id % 19 <> 0 THEN CAST(event_id % 103 AS DOUBLE) END AS Sog,
         CASE WHEN event_id % 23 <> 0 THEN CAST(event_id % 257 - 128 AS INTEGER) END AS RateOfTurn,
         CASE WHEN event_id % 11 <> 0 THEN CAST(event_id % 3 AS INTEGER) END AS SMI,
         CASE WHEN event_id % 5 <> 0 THEN
              CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END END AS PA,
         CASE WHEN mtype = '{SAR}' AND event_id % 7 <> 0
              THEN CAST((event_id % 5) * 100 AS INTEGER) END AS Altitude
  FROM fx5 WHERE event_id % {fixture.BAD_EVERY} <> {fixture.BAD_EVERY - 1})"""


#: A report's JSON as one of an array is written: numbers without trailing zeros.
WRITTEN_SQL = "regexp_replace(regexp_replace(obj, '(\\.\\d*?)0+([,}])', '\\1\\2', 'g'), '\\.([,}])', '\\1', 'g')"


def with_reports(body: str, extra_ctes: str = "") -> str:
    """``WITH`` fixture CTEs, ``raw_topic``, ``reports`` [+ extra] ``body``."""
    ctes = fixture.duckdb_raw_topic_cte() + "," + REPORTS_CTE
    if extra_ctes:
        ctes += ",\n" + extra_ctes
    return f"WITH {ctes}\n{body}"


def with_envelopes(body: str, extra_ctes: str = "") -> str:
    ctes = fixture.duckdb_envelope_topic_cte()
    if extra_ctes:
        ctes += ",\n" + extra_ctes
    return f"WITH {ctes}\n{body}"
