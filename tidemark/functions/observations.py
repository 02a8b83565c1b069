"""Station reports: decoding scaled fields, quality flags, classes of days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Report kinds that are summaries, not observations; plausible temperatures; flags of a day in order; wind directions that say "missing".
SUMMARY_REPORTS = ("SOD", "SOM")
LEAST_F, MOST_F = -40.0, 120.0
FLAGS = ("SPARSE_DAY", "ZERO_TEMPERATURE_DAY", "IMPLAUSIBLE_TEMPERATURE", "LARGE_GAP", "DUPLICATES")
NO_DIRECTION = (999, 9999, -999, -9999)
FRESH_HOURS = 6.0
#: Further current values that a state shows.
MORE = ("dewpoint_f", "wind_speed_ms", "station_pressure_hpa")


def scaled(raw: Column, scale: float = 10.0) -> Column:
    """A signed whole number over ``scale``. Blank, all nines at any width, or no number: null."""
    v = F.trim(raw)
    return F.when(~v.rlike(r"^[+-]*9+$"), v.try_cast("int") / scale)


def part(field: Column, i: int, at_least: int) -> Column:
    """Sub-field ``i`` of a comma list that has at least ``at_least`` sub-fields."""
    parts = F.split(field, ",")
    return F.when(F.size(parts) >= at_least, F.get(parts, F.lit(i)))


def fahrenheit(celsius: Column) -> Column:
    return celsius * 9 / 5 + 32


def kelvin_to_f(value: Column, units: Column) -> Column:
    """Only values in kelvin are converted; others have none."""
    return F.when(units == "K", fahrenheit(value - 273.15))


def decoded(raw: DataFrame) -> DataFrame:
    """Typed columns from the raw string columns; columns that a year's file lacks count as empty."""
    c = lambda name: F.coalesce(F.col(name), F.lit("")) if name in raw.columns else F.lit("")
    blank = lambda x: F.when(F.trim(x) != "", F.trim(x))
    t, d = scaled(part(c("TMP"), 0, 2)), scaled(part(c("DEW"), 0, 2))
    direction = part(c("WND"), 0, 5).try_cast("int")
    flags = {k: part(c(n), 1, 2) for k, n in (("tmp", "TMP"), ("dew", "DEW"), ("slp", "SLP"))}
    return raw.select(
        F.try_to_timestamp(c("DATE")).alias("observation_time"),
        F.trim(c("REPORT_TYPE")).alias("report_type_raw"), F.trim(c("QUALITY_CONTROL")).alias("quality_control_version"), F.trim(c("SOURCE")).alias("source_code"),
        c("TMP").alias("temperature_raw"), t.alias("temperature_c"), fahrenheit(t).alias("temperature_f"), flags["tmp"].alias("temperature_qc_flag"),
        c("DEW").alias("dewpoint_raw"), d.alias("dewpoint_c"), fahrenheit(d).alias("dewpoint_f"), flags["dew"].alias("dewpoint_qc_flag"),
        F.lit(None).cast("double").alias("relative_humidity"),
        F.when(~direction.isin(*NO_DIRECTION), direction.cast("double")).alias("wind_direction_deg"), scaled(part(c("WND"), 3, 5)).alias("wind_speed_ms"), scaled(part(c("OC1"), 0, 1)).alias("wind_gust_ms"),
        scaled(part(c("MA1"), 2, 4)).alias("station_pressure_hpa"), scaled(part(c("SLP"), 0, 2)).alias("sea_level_pressure_hpa"), scaled(part(c("AA1"), 1, 2)).alias("precipitation_mm"),
        blank(c("GA1")).alias("cloud_cover_raw"), scaled(part(c("VIS"), 0, 1), 1.0).alias("visibility_m"), F.coalesce(blank(c("AW1")), blank(c("MW1"))).alias("weather_codes_raw"),
        F.create_map(*[x for k, v in flags.items() for x in (F.lit(k), v)]).alias("quality_flags_raw"),
        (~F.trim(c("REPORT_TYPE")).isin(*SUMMARY_REPORTS)).alias("is_real_observation"),
    )


def quality_flags(n: Column, n_temperature: Column, most: Column, largest_gap_minutes: Column, n_duplicates: Column, wanted: tuple[str, ...] = FLAGS) -> Column:
    """What is wrong with a station's day, joined by ``;``; OK if nothing. A day without rows has that flag alone. ``wanted``: the flags to look for."""
    rules = dict(
        zip(
            FLAGS,
            (
                F.when(n < 12, "SPARSE_DAY"),
                F.when(n_temperature == 0, "ZERO_TEMPERATURE_DAY"),
                F.when((most < LEAST_F) | (most > MOST_F), "IMPLAUSIBLE_TEMPERATURE"),
                F.when(largest_gap_minutes > 180, "LARGE_GAP"),
                F.when(n_duplicates > 0, F.concat(F.lit("DUPLICATES("), n_duplicates.cast("string"), F.lit(")"))),
            ),
            strict=True,
        )
    )
    joined = F.array_join(F.array_compact(F.array(*[rules[x] for x in wanted])), ";")
    return F.when(n == 0, "ZERO_OBSERVATION_DAY").when(joined == "", "OK").otherwise(joined)


def station_days(obs: DataFrame, by: list[str], time_us: str, value: str, wanted: tuple[str, ...] = FLAGS) -> DataFrame:
    """Per station and day: observations, extremes, largest gap, duplicates, flags. ``by``: station, day; ``wanted``: the flags to look for."""
    from pyspark.sql import Window

    gap = (F.col(time_us) - F.lag(time_us).over(Window.partitionBy(*by).orderBy(time_us))) / 6e7
    g = obs.withColumn("__gap", gap).groupBy(*by).agg(F.count("*").alias("n"), F.count(value).alias("n_temperature"), F.max(value).alias("most"), F.max("__gap").alias("largest_gap"), (F.count("*") - F.countDistinct(time_us)).alias("n_duplicates"))
    return g.withColumn("flags", quality_flags(*[F.col(c) for c in ("n", "n_temperature", "most", "largest_gap", "n_duplicates")], wanted))


def season_bucket(month: Column) -> Column:
    """The seasons days are drawn from."""
    return F.when(month <= 2, "winter_jan_feb").when(month <= 5, "spring").when(month == 6, "early_summer").when(month == 7, "midsummer").otherwise("august")


def temperature_bucket(tmax_f: Column) -> Column:
    """Classes of a day's maximum."""
    return F.when(tmax_f < 25, "very_cold").when(tmax_f < 45, "cold").when(tmax_f < 65, "moderate").when(tmax_f < 85, "warm").otherwise("very_hot")


def weather_regime(precipitation: Column, storm: Column, clouds: Column) -> Column:
    """Class of a day; ``clouds``: its raw cloud fields, of which codes up to 9 count and 5 and more are cloudy."""
    codes = F.filter(F.transform(clouds, lambda x: F.get(F.split(x, ","), F.lit(0)).try_cast("int")), lambda x: x <= 9)
    cloudy = F.size(F.filter(codes, lambda x: x >= 5)) / F.nullif(F.size(codes), F.lit(0)) > 0.4
    return F.when(storm, "active_storm").when(precipitation, "precipitation").when(cloudy, "cloudy").otherwise("clear_dry")


def state(obs: DataFrame, states: DataFrame, by: list[str], fresh_hours: float = FRESH_HOURS) -> DataFrame:
    """Per (state, station): the latest report known at the state's time, changes against the one before and an hour earlier,
    and the day's maximum so far.

    ``obs``: by columns, observation_time, temperature_f; ``states``: state_id, query_time, day_start, day_end. Current
    values are null when the latest report is older than ``fresh_hours``; its age and the day's maximum stay.
    """
    from tidemark.operators.asof import asof_join, last_two
    from tidemark.operators.joins import small

    stations = obs.select(*by).distinct()
    us = F.unix_micros
    more = [c for c in MORE if c in obs.columns]
    o = obs.filter("observation_time is not null").select(*by, us("observation_time").alias("at"), "temperature_f", *more)
    s = states.select("state_id", us("query_time").alias("t"), us("day_start").alias("from_us"), us("day_end").alias("to_us")).crossJoin(small(stations))  # stations are a dimension; the product is the result
    two = last_two(s, o, by, "t", "at")
    hour = asof_join(two.withColumn("back", F.col("latest.at") - 3_600_000_000), o, by, "back", "at", to="hour_ago")
    age = F.col("t") - F.col("latest.at")
    fresh = age <= int(fresh_hours * 3_600_000_000)
    # the day's maximum so far: running maxima per station and day, then one more as-of look
    day = o.join(small(states.select(us("day_start").alias("from_us"), us("day_end").alias("to_us")).distinct()), (F.col("at") >= F.col("from_us")) & (F.col("at") < F.col("to_us")))
    from pyspark.sql import Window

    w = Window.partitionBy(*by, "from_us").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    best = F.max(F.when(F.col("temperature_f").isNotNull(), F.struct("temperature_f", (-F.col("at")).alias("first")))).over(w)
    running = day.select(*by, "from_us", "at", best.alias("best"))
    out = asof_join(hour, running, [*by, "from_us"], "t", "at", to="day")
    now = F.col("latest.temperature_f")
    return out.select(
        "state_id", *by, F.col("latest.at").isNotNull().alias("has_eligible"), F.coalesce(fresh, F.lit(False)).alias("available"), (~fresh).alias("stale"), (age / 6e7).alias("age_minutes"), F.when(fresh, now).alias("current_f"),
        F.when(fresh, now - F.col("previous.temperature_f")).alias("change_previous_f"), F.when(fresh, now - F.col("hour_ago.temperature_f")).alias("change_1h_f"), F.col("day.best.temperature_f").alias("tmax_so_far_f"), (-F.col("day.best.first")).alias("time_of_max_us"),
        F.col("latest.at").alias("latest_us"), *[F.when(fresh, F.col(f"latest.{c}")).alias(f"current_{c}") for c in more],
    )
