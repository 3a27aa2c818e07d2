"""Suggested prices: tariffs and rules as small tables, five lookups, bands and rush hours."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrain.functions.time import local
from tidegrain.schemas import PRICE, conform

DAYS = ("mon", "tue", "wed", "thu", "fri", "sat", "sun")


class PricingError(ValueError):
    """All problems of a tariff or rule file at once."""


@dataclass(frozen=True)
class Rules:
    """bands: (name, below or None, multiplier); rush: (name, weekdays, from hour, to hour, multiplier); limits: facility to (min or None, max or None)."""

    bands: tuple = (("low", 0.5, 0.8), ("normal", 0.85, 1.0), ("high", None, 1.25))
    rush: tuple = (("morning", (1, 2, 3, 4, 5), 7, 9, 1.1), ("afternoon", (1, 2, 3, 4, 5), 15, 17, 1.1))
    min_multiplier: float = 0.5
    max_multiplier: float = 1.5
    limits: dict = field(default_factory=dict)
    max_stale_share: float = 0.5
    min_covered_minutes: float = 30

    def __post_init__(self):
        wrong, edges = [], [b for _, b, _ in self.bands]
        if not edges or edges[-1] is not None or None in edges[:-1]:
            wrong.append("the last band, and only it, is open")
        if any(a >= b for a, b in zip(edges, edges[1:-1], strict=False)):
            wrong.append("bands rise")
        if any(m <= 0 for *_, m in (*self.bands, *self.rush)) or self.min_multiplier <= 0:
            wrong.append("multipliers are positive")
        if self.min_multiplier > self.max_multiplier or any(lo is not None and hi is not None and lo > hi for lo, hi in self.limits.values()):
            wrong.append("a minimum is at most its maximum")
        cells = [(d, h) for _, days, a, b, _ in self.rush for d in days for h in range(a, b)]
        if len(cells) != len(set(cells)):
            wrong.append("rush windows don't overlap")
        if wrong:
            raise PricingError("; ".join(wrong))


def whole_hour(text: str) -> int:
    h, _, m = str(text).partition(":")
    if not h.isdigit() or m not in ("", "00") or int(h) > 24:
        raise PricingError(f"not a whole hour: {text}")
    return int(h)


def tariffs(spark: SparkSession, facilities: list[dict]) -> DataFrame:
    """facility, weekday_number, hour, base_price (per hour, twice the published half-hour price) for every hour of a week.

    Periods without weekdays cover each hour once; those with weekdays go over them.
    """
    rows, wrong = [], []
    for f in facilities:
        week: dict[tuple[int, int], float] = {}
        seen: list[tuple[int, int]] = []
        for p in sorted(f["periods"], key=lambda p: "weekdays" in p):
            days = [DAYS.index(d) + 1 for d in p["weekdays"]] if "weekdays" in p else list(range(1, 8))
            cells = [(d, h) for d in days for h in range(whole_hour(p["from"]), whole_hour(p["to"]))]
            if "weekdays" not in p:
                seen += cells
            week.update(dict.fromkeys(cells, float(p["price"])))
        if len(seen) != 168 or len(set(seen)) != 168:
            wrong.append(f"{f['facility']}: periods cover each hour of the week once")
        rows += [(f["facility"], d, h, 2 * price) for (d, h), price in week.items()]
    if wrong or not rows:
        raise PricingError("; ".join(wrong) or "no facilities")
    return spark.createDataFrame(rows, "facility string, weekday_number int, hour int, base_price double")


def suggested_prices(hourly: DataFrame, facilities: DataFrame, tariff: DataFrame, rules: Rules = Rules(), zone: str = "Europe/Oslo") -> DataFrame:
    """A price for each facility and hour, with the rule that made it, or the reason why there is none.

    All lookup tables are small (facilities, a week's hours) and left to the optimiser to broadcast by their size. A
    capacity of 0 gives no occupancy. Prices are rounded half to even.
    """
    spark = hourly.sparkSession
    rush = spark.createDataFrame([(n, d, h, float(m)) for n, days, a, b, m in rules.rush for d in days for h in range(a, b)] or [], "rush_window string, weekday_number int, hour int, rush double")
    limits = spark.createDataFrame([(f, *(None if x is None else float(x) for x in pair)) for f, pair in rules.limits.items()] or [], "facility string, low double, high double")
    seen = hourly.groupBy("facility_key").agg(F.max("max_spaces").alias("_seen"))
    dim = facilities.select("facility_key", F.col("facility_name").alias("facility"), F.col("capacity").alias("_capacity"))
    wall = local(F.col("hour_start"), zone)
    h = hourly.withColumn("weekday_number", F.weekday(wall) + 1).withColumn("hour", F.col("hour").cast("int"))
    h = h.join(dim, "facility_key", "left").join(seen, "facility_key", "left")
    h = h.join(tariff, ["facility", "weekday_number", "hour"], "left").join(rush, ["weekday_number", "hour"], "left").join(limits, "facility", "left")
    h = h.withColumns({"capacity": F.coalesce("_capacity", "_seen"), "capacity_is_estimated": F.col("_capacity").isNull() & F.col("_seen").isNotNull()})
    h = h.withColumn("occupancy", 1 - F.try_divide(F.col("avg_spaces"), F.col("capacity")))
    band, factor = F.lit(rules.bands[-1][0]), F.lit(float(rules.bands[-1][2]))
    for name, below, m in reversed(rules.bands[:-1]):
        band, factor = F.when(F.col("occupancy") < below, name).otherwise(band), F.when(F.col("occupancy") < below, float(m)).otherwise(factor)
    h = h.withColumns({"band": band, "multiplier": factor * F.coalesce("rush", F.lit(1.0))})
    status = (
        F.when(F.col("avg_spaces").isNull() | F.col("capacity").isNull() | F.col("occupancy").isNull() | (F.col("covered_minutes") < rules.min_covered_minutes), "no_data")
        .when(F.col("stale_minutes") > rules.max_stale_share * F.col("covered_minutes"), "stale")
        .when(F.col("base_price").isNull(), "no_tariff")
        .otherwise("priced")
    )
    h = h.withColumns({"status": status, "_raw": F.col("base_price") * F.col("multiplier"), "_low": F.coalesce("low", F.col("base_price") * rules.min_multiplier), "_high": F.coalesce("high", F.col("base_price") * rules.max_multiplier)})
    priced = F.col("status") == "priced"
    price = F.bround(F.greatest(F.least("_raw", "_high"), "_low"), 0)
    capped = F.when(F.col("_raw") > F.col("_high"), " (capped at the maximum)").when(F.col("_raw") < F.col("_low"), " (raised to the minimum)").otherwise("")
    rule = F.concat(F.lit("occupancy:"), "band", F.when(F.col("rush_window").isNotNull(), F.concat(F.lit(" rush:"), "rush_window")).otherwise(""), capped)
    return conform(h.withColumns({"suggested_price": F.when(priced, price), "applied_rule": F.when(priced, rule).otherwise(F.col("status"))}), PRICE)
