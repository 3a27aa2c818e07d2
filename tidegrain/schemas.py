"""Fixed schemas of the tables, and the projection that makes a frame conform to one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

KINDS = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "smallint": T.ShortType(), "tinyint": T.ByteType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(), "decimal(10,7)": T.DecimalType(10, 7)}


def schema(ddl: str) -> StructType:
    """A struct of simple types from "name type, ..."; unlike StructType.fromDDL it needs no session."""
    return StructType([T.StructField(n, KINDS[k]) for n, k in (x.split(" ") for x in ddl.split(", "))])


LINEAGE = "source_id string, raw_file string, record_index int, ingested_at timestamp"
READING = schema(f"{LINEAGE}, facility string, reading_at timestamp, reading_date date, reading_minute_of_day smallint, utc_offset_minutes smallint, dst_resolved boolean, latitude decimal(10,7), longitude decimal(10,7), available_spaces int, status string")
#: A reading with the last fetch that showed it.
FIRST = StructType([*READING, T.StructField("last_fetched_at", T.TimestampType())])
QUARANTINE = schema(f"{LINEAGE}, field string, raw_value string, reason string, reading_excluded boolean")
SNAPSHOT = schema("source_id string, raw_file string, ingested_at timestamp, source_reading_at timestamp, age_minutes double, is_stale boolean")
STALE_PERIOD = schema("source_id string, source_reading_at timestamp, stale_from timestamp, first_stale_fetch_at timestamp, last_stale_fetch_at timestamp, fetch_count int, ongoing boolean")
AREA = schema(f"{LINEAGE}, register_id bigint, name string, paid_spaces int, free_spaces int, charging_spaces int, disabled_spaces int, changed_at timestamp, deactivated_at timestamp")
DIM_DATE = schema("date_key int, date date, year smallint, quarter tinyint, month tinyint, month_name string, day tinyint, iso_year smallint, iso_week tinyint, weekday_number tinyint, weekday string, is_weekend boolean, is_public_holiday boolean, holiday_name string")
DIM_TIME = schema("time_key smallint, minute_of_day smallint, hour tinyint, minute tinyint, quarter_hour string, time_label string, day_part string")
FACILITY = schema("facility_key int, facility_name string, latitude decimal(10,7), longitude decimal(10,7), capacity int, capacity_changed_at timestamp, register_id bigint, first_seen timestamp, last_seen timestamp, is_active boolean")
AVAILABILITY = schema("facility_key int, source_id string, valid_from timestamp, valid_to timestamp, first_ingested_at timestamp, last_fetched_at timestamp, date_key int, time_key smallint, available_spaces int, occupied_spaces int, status string, duration_minutes double, is_stale boolean, is_source_glitch boolean")
HOURLY = schema("facility_key int, hour_start timestamp, date_key int, hour tinyint, avg_spaces double, min_spaces int, max_spaces int, observation_count int, covered_minutes double, counted_minutes double, stale_minutes double")
PRICE = schema("facility_key int, hour_start timestamp, date_key int, hour tinyint, occupancy double, capacity int, capacity_is_estimated boolean, band string, rush_window string, multiplier double, base_price double, suggested_price double, status string, applied_rule string")
STALE_FACT = schema("source_id string, source_reading_at timestamp, stale_from timestamp, stale_until timestamp, date_key int, duration_minutes double, fetch_count int, ongoing boolean")
CHECK = schema("check string, severity string, subject string, passed boolean, detail string, snapshot string, checked_at timestamp")
LOAD_ISSUE = schema("source_id string, raw_file string, reason string, detail string, detected_at timestamp")
RUNS = schema("run_id bigint, run_attempt int, started_at timestamp, failed_step string, url string")
OUTAGE = schema("source_id string, raw_file string, observed_at timestamp, source_url string, run_id string, http_status int")


def conform(df: DataFrame, to: StructType) -> DataFrame:
    """Exactly the columns of a schema, in its order and types; extra columns go."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in to])
