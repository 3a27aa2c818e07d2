"""The report pages as queries over the star schema; slicers are filters on the dimensions before any measure."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrain.plans import measures as m


class Report:
    """t: dim_date, dim_parking_facility, fact_parking_availability, fact_parking_hourly, fact_source_stale_period, quality_check_results."""

    def __init__(self, t: dict[str, DataFrame], dates: Column | None = None, facilities: Column | None = None):
        self.dates = t["dim_date"] if dates is None else t["dim_date"].where(dates)
        self.dim = t["dim_parking_facility"] if facilities is None else t["dim_parking_facility"].where(facilities)
        d = self.dates.select("date_key", "date", "weekday", "weekday_number", "is_public_holiday")
        f = self.dim.select("facility_key", "facility_name")
        self.hourly = t["fact_parking_hourly"].join(d, "date_key").join(f, "facility_key")
        self.avail = t["fact_parking_availability"].join(d, "date_key").join(f, "facility_key")
        self.stale = t["fact_source_stale_period"].join(d, "date_key")
        self.checks = t["quality_check_results"]

    def free_spaces_line(self) -> DataFrame:
        return m.free_spaces_avg(self.hourly, ["date", "hour", "facility_name"]).orderBy("date", "hour", "facility_name")

    def latest_card(self) -> DataFrame:
        return m.free_spaces_latest(self.avail, [])

    def occupancy_matrix(self) -> DataFrame:
        return m.occupancy(self.hourly, self.dim, ["weekday_number", "weekday", "hour"], fresh_only=True).orderBy("weekday_number", "hour")

    def facility_table(self) -> DataFrame:
        by = ["facility_name"]
        parts = [m.capacity(self.dim, by), m.free_spaces_latest(self.avail, by), m.occupancy_latest(self.avail, self.dim, by), m.data_age_minutes(self.avail, by)]
        return reduce(lambda a, b: a.join(b, by, "left"), parts).orderBy(*by)

    def stale_timeline(self) -> DataFrame:
        return m.coverage(self.hourly, ["date"]).join(m.occupancy(self.hourly, self.dim, ["date"], fresh_only=True), "date", "left").select("date", "stale_share", "occupancy_fresh").orderBy("date")

    def covered_minutes(self) -> DataFrame:
        return m.coverage(self.hourly, ["date"]).select("date", "covered_minutes", "covered_us").orderBy("date")

    def stale_periods(self) -> DataFrame:
        return self.stale.select("stale_from", F.when(F.col("ongoing"), "ongoing").otherwise(F.date_format("stale_until", "yyyy-MM-dd HH:mm")).alias("ended"), (F.col("duration_minutes") / 1440).alias("stale_days"), "fetch_count").orderBy("stale_from")

    def failed_checks(self) -> DataFrame:
        return m.failed_checks(self.checks, ["severity", "check", "subject", "detail"]).orderBy(F.col("severity") != "critical", "check", "subject")

    def status_cards(self) -> DataFrame:
        return m.source_status(self.avail, []).join(m.data_age_minutes(self.avail, []))
