"""Date and time dimensions, with Norwegian public holidays."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrain.functions.time import date_key
from tidegrain.schemas import DIM_DATE, DIM_TIME, conform

# The official names of public holidays, on fixed dates and by days from Easter Sunday.
FIXED_HOLIDAYS = [("01-01", "Første nyttårsdag"), ("05-01", "Offentlig høytidsdag"), ("05-17", "Grunnlovsdag"), ("12-25", "Første juledag"), ("12-26", "Andre juledag")]
EASTER_HOLIDAYS = [(-7, "Palmesøndag"), (-3, "Skjærtorsdag"), (-2, "Langfredag"), (0, "Første påskedag"), (1, "Andre påskedag"), (39, "Kristi himmelfartsdag"), (49, "Første pinsedag"), (50, "Andre pinsedag")]
DAY_PARTS = [(6, "night"), (10, "morning"), (14, "midday"), (18, "afternoon"), (24, "evening")]


def easter(years: DataFrame) -> DataFrame:
    """year and Easter Sunday (Oudin's integer method, counted in days from 28 March)."""
    steps = [
        ("g", "year % 19"),
        ("c", "year div 100"),
        ("h", "pmod(c - c div 4 - (8 * c + 13) div 25 + 19 * g + 15, 30)"),
        ("i", "h - (h div 28) * (1 - (29 div (h + 1)) * ((21 - g) div 11))"),
        ("j", "pmod(year + year div 4 + i + 2 - c + c div 4, 7)"),
    ]
    for name, e in steps:
        years = years.withColumn(name, F.expr(e))
    return years.select("year", F.expr("date_add(make_date(cast(year as int), 3, 28), cast(i - j as int))").alias("easter"))


def holidays(spark: SparkSession, first: int, last: int) -> DataFrame:
    """date and name; two holidays of one day are joined by a comma, the fixed one first."""
    years = spark.range(first, last + 1).withColumnRenamed("id", "year")
    fixed = spark.createDataFrame([(i, *x) for i, x in enumerate(FIXED_HOLIDAYS)], "rank int, md string, name string")
    moving = spark.createDataFrame([(100 + i, *x) for i, x in enumerate(EASTER_HOLIDAYS)], "rank int, days int, name string")
    a = years.join(F.broadcast(fixed)).select(F.to_date(F.concat(F.col("year").cast("string"), F.lit("-"), "md")).alias("date"), "rank", "name")
    b = easter(years).join(F.broadcast(moving)).select(F.date_add("easter", F.col("days")).alias("date"), "rank", "name")
    return a.union(b).groupBy("date").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "name"))), lambda x: x["name"]), ", ").alias("holiday_name"))


#: What a report's model has to know of columns (fixed values): the key, the kind, and the column that a label is sorted by.
MODEL = {"date_key": {"isKey": True}, "date": {"dataCategory": "PaddedDateTableDates"}, "month_name": {"sortByColumn": "month"}, "weekday": {"sortByColumn": "weekday_number"}}


def dim_date(spark: SparkSession, first: dt.date = dt.date(2020, 1, 1), last: dt.date = dt.date(2035, 12, 31)) -> DataFrame:
    d = spark.sql(f"select explode(sequence(date'{first}', date'{last}', interval 1 day)) as date")
    d = d.join(F.broadcast(holidays(spark, first.year, last.year)), "date", "left")
    day = F.col("date")
    number = F.weekday(day) + 1
    out = conform(
        d.withColumns(
            {
                "date_key": date_key(day), "year": F.year(day), "quarter": F.quarter(day), "month": F.month(day), "month_name": F.date_format(day, "MMMM"),
                "day": F.day(day), "iso_year": F.extract(F.lit("YEAROFWEEK"), day), "iso_week": F.weekofyear(day), "weekday_number": number,
                "weekday": F.date_format(day, "EEEE"), "is_weekend": number > 5, "is_public_holiday": F.col("holiday_name").isNotNull(),
            }
        ),
        DIM_DATE,
    )
    return out.select(*[F.col(c).alias(c, metadata=MODEL[c]) if c in MODEL else F.col(c) for c in out.columns])


def dim_time(spark: SparkSession) -> DataFrame:
    m = spark.range(1440).withColumnRenamed("id", "minute_of_day")
    h, r = F.expr("minute_of_day div 60"), F.col("minute_of_day") % 60
    part = F.lit(DAY_PARTS[-1][1])
    for before, name in reversed(DAY_PARTS[:-1]):
        part = F.when(h < before, name).otherwise(part)
    label = lambda x: F.format_string("%02d:%02d", h, x)
    return conform(m.withColumns({"hour": h, "minute": r, "time_key": h * 100 + r, "quarter_hour": label(r - r % 15), "time_label": label(r), "day_part": part}), DIM_TIME)
