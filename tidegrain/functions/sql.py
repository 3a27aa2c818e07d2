"""The typing, wall clock and interval rules as SQL functions, for queries written in spark.sql.

register(spark) makes them known to the session. Each is a SQL expression, so a query with them is one plan that Catalyst
optimises, without Python. A null argument gives null, but for not_after of utc_of (then the earlier instant counts) and
valid_to of covered_to (an open interval).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

FUNCTIONS = {
    # typed text: what isn't plainly of a type is null
    "count_of": r"(s STRING) RETURNS INT RETURN CASE WHEN s RLIKE r'^[0-9]+\z' THEN TRY_CAST(s AS INT) END",
    "decimal_of": r"(s STRING) RETURNS DECIMAL(10,7) RETURN CASE WHEN s RLIKE r'^[+-]?[0-9]+(\.[0-9]+)?\z' THEN TRY_CAST(s AS DECIMAL(10,7)) END",
    "instant_of": r"(s STRING) RETURNS TIMESTAMP RETURN CASE WHEN s RLIKE r'(Z|[+-][0-9]{2}:?[0-9]{2})\z' THEN TRY_TO_TIMESTAMP(s) END",
    # wall clocks
    "wall_micros": "(us BIGINT, zone STRING) RETURNS BIGINT RETURN UNIX_MICROS(FROM_UTC_TIMESTAMP(TIMESTAMP_MICROS(us), zone))",
    # the instant that the zone's offset of some time near the wall clock gives, if clocks do show it then
    "instant_by_offset": "(wall BIGINT, near BIGINT, zone STRING) RETURNS BIGINT RETURN CASE WHEN wall_micros(wall - (wall_micros(near, zone) - near), zone) = wall THEN wall - (wall_micros(near, zone) - near) END",
    "later_if": "(a BIGINT, b BIGINT, not_after BIGINT) RETURNS TIMESTAMP RETURN TIMESTAMP_MICROS(CASE WHEN GREATEST(a, b) <= not_after THEN GREATEST(a, b) ELSE LEAST(a, b) END)",
    # the instant of a wall clock: of two the later one, unless it is after not_after; null where clocks skip it
    "utc_of": "(wall TIMESTAMP_NTZ, zone STRING, not_after TIMESTAMP) RETURNS TIMESTAMP RETURN later_if("
    "instant_by_offset(UNIX_MICROS(CAST(wall AS TIMESTAMP)), UNIX_MICROS(CAST(wall AS TIMESTAMP)) - 172800000000, zone), "
    "instant_by_offset(UNIX_MICROS(CAST(wall AS TIMESTAMP)), UNIX_MICROS(CAST(wall AS TIMESTAMP)) + 172800000000, zone), UNIX_MICROS(not_after))",
    "date_key_of": "(d DATE) RETURNS INT RETURN YEAR(d) * 10000 + MONTH(d) * 100 + DAY(d)",
    # intervals
    "whole_second_minutes": "(a TIMESTAMP, b TIMESTAMP) RETURNS DOUBLE RETURN CAST((UNIX_MICROS(a) - UNIX_MICROS(b)) / 1000000 AS BIGINT) / 60",
    "exact_minutes": "(a TIMESTAMP, b TIMESTAMP) RETURNS DOUBLE RETURN (UNIX_MICROS(a) - UNIX_MICROS(b)) / 60000000",
    # how far an interval is evidence: to max_gap past its last fetch at most, and to the last fetch if it is open
    "covered_to": "(valid_to TIMESTAMP, last_fetched_at TIMESTAMP, max_gap INTERVAL DAY TO SECOND) RETURNS TIMESTAMP RETURN CASE WHEN valid_to IS NULL THEN last_fetched_at ELSE LEAST(valid_to, last_fetched_at + max_gap) END",
    # the hours that [a, b) touches; null where it is empty
    "hours_of": "(a TIMESTAMP, b TIMESTAMP) RETURNS ARRAY<TIMESTAMP> RETURN CASE WHEN b > a THEN SEQUENCE(DATE_TRUNC('HOUR', a), DATE_TRUNC('HOUR', b - INTERVAL '0.000001' SECOND), INTERVAL '1' HOUR) END",
    "micros_within_hour": "(a TIMESTAMP, b TIMESTAMP, hour_start TIMESTAMP) RETURNS BIGINT RETURN UNIX_MICROS(LEAST(b, hour_start + INTERVAL '1' HOUR)) - UNIX_MICROS(GREATEST(a, hour_start))",
}


def register(spark: SparkSession) -> None:
    """Makes the functions known to the session, in the order in which they call each other. All assume a UTC session."""
    for name, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
