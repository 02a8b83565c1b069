"""A state of the world at an instant, from all sources: one wide row, long tables, and a compact document.

Everything is joined on ``state_id`` from parts that were each reduced first; no part multiplies another's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import observations, text, times
from tidemark.operators import audit, pit
from tidemark.operators.asof import last_two
from tidemark.operators.joins import small
from tidemark.sources.sinks import staged

#: Deterministic sources, stations and their names, statistics of the ensemble and their column names.
MODELS = ("hrrr", "gfs", "nbm", "ecmwf_deterministic")
STATIONS = {"725053-94728": "KNYC", "725030-14732": "KLGA", "744860-94789": "KJFK", "725020-14734": "KEWR"}
ORDER = (*MODELS, "gefs_median")
ENSEMBLE = ("mean", "p50", "std", "min", "max", "p10", "p25", "p75", "p90")


class Parts:
    """What a set of states needs, computed once: runs, members, stations, bulletins, comparisons.

    ``states``: of ``times.state_grid``; ``forecasts``: the gridded table with ``available_time`` resolved; ``stations``:
    decoded reports; ``bulletins``: product_id, issuance_time, raw_text. Strict states see no station and no bulletin.
    The forecasts are read once here, condensed to what the states can tell apart; trajectories read them again.
    """

    def __init__(self, states: DataFrame, forecasts: DataFrame, stations: DataFrame, bulletins: DataFrame, schedule: DataFrame, members: dict[str, int] | None = None):
        states = staged(states)
        self.states, self.forecasts, self.bulletins = states, forecasts, bulletins
        self.days = staged(states.select("day", "day_start", "day_end").distinct())
        rows = staged(pit.condensed(pit.temperature_rows(forecasts).withColumn("value", F.col("value_f")), states))
        self.members = pit.MEMBERS if members is None else members
        self.full, self.chosen = pit.chosen_runs(states, rows, self.days, schedule, self.members)
        self.runs = staged(pit.forecast_states(states, rows, self.days, schedule, self.members, found=(self.full, self.chosen)))
        self.values = pit.run_values(states, rows, self.chosen, self.days).drop("path")
        self.maxima = pit.member_maxima(states, rows, self.chosen.filter(F.col("source") == "gefs"), self.days)
        self.before = pit.member_maxima(states, rows, self.chosen.filter(F.col("source") == "gefs"), self.days, "previous")
        proxy = states.filter("mode = 'proxy'")
        real = stations.filter("is_real_observation") if "is_real_observation" in stations.columns else stations
        self.stations = observations.state(real, proxy, ["station_id"])
        b = bulletins.filter("issuance_time is not null").select("product_id", F.unix_micros("issuance_time").alias("at"), F.lit(1).alias("all"))
        q = proxy.select("state_id", F.unix_micros("query_time").alias("t"), F.lit(1).alias("all"))
        self.texts = last_two(q, b, ["all"], "t", "at", ["product_id"]).select("state_id", "t", "latest", "previous")

    def ensemble(self) -> DataFrame:
        """(state_id, statistics of the members' maxima, revision of the mean)"""
        p = F.expr("percentile(daily_max, array(0.1, 0.25, 0.5, 0.75, 0.9))")
        g = self.maxima.groupBy("state_id").agg(F.avg("daily_max").alias("mean"), F.stddev_samp("daily_max").alias("std"), F.min("daily_max").alias("min"), F.max("daily_max").alias("max"), p.alias("p"), F.count("*").alias("members"))
        old = self.before.groupBy("state_id").agg(F.avg("daily_max").alias("old_mean"), F.expr("percentile(daily_max, 0.5)").alias("old_median"))
        named = g.select("state_id", "mean", "std", "min", "max", "members", *[F.col("p")[i].alias(n) for i, n in enumerate(("p10", "p25", "p50", "p75", "p90"))])
        return named.join(old, "state_id", "left").withColumn("revision_mean", F.col("mean") - F.col("old_mean")).withColumn("revision_median", F.col("p50") - F.col("old_median")).drop("old_mean", "old_median")

    def comparison(self) -> DataFrame:
        det = self.runs.filter(F.col("source").isin(*MODELS)).select("state_id", "source", "tmax")
        return pit.cross_model(det.unionByName(self.ensemble().select("state_id", F.lit("gefs_median").alias("source"), F.col("p50").alias("tmax"))), ORDER)


def _by(df: DataFrame, key: str, names: dict[str, str], columns: list[str]) -> DataFrame:
    """One struct column per name: a conditional sum instead of a pivot that would first look for the names."""
    return df.groupBy("state_id").agg(*[F.max(F.when(F.col(key) == k, F.struct(*columns))).alias(n) for k, n in names.items()])


def structured_features(parts: Parts, labels: DataFrame | None = None) -> DataFrame:
    """One row a state. ``labels``: day and five label columns (label_tmax_f, label_time_of_max, label_observation_count,
    label_largest_gap_minutes, label_quality) or any others; they are joined by day."""
    s = parts.states
    left = times.day_progress(F.col("query_time"), F.col("day"))[1]
    key = s.select("state_id", F.col("day").alias("target_date"), F.col("query_time").alias("query_time_utc"), F.from_utc_timestamp("query_time", times.ZONE).alias("query_time_local"), F.col("mode").alias("state_mode"), "local_hour", F.dayofyear("day").alias("day_of_year"), F.month("day").alias("month"), left.alias("hours_until_end_of_local_day"))
    if labels is not None:
        key = key.join(labels.withColumnRenamed("day", "target_date"), "target_date", "left")
    columns = ["usable_for_daily_max", "newer_run_arriving", "usable_run", "usable_since", "age_hours", "tmax", "previous_run", "previous_tmax", "revision", "seen_run", "seen_status"]
    runs = _by(parts.runs, "source", {k: k for k in (*MODELS, "gefs")}, columns)
    out = [F.col(c) for c in key.columns]
    for k in MODELS:
        f = lambda c, k=k: F.col(f"{k}.{c}")
        no = lambda c: F.coalesce(f(c), F.lit(False))  # noqa: E731, B023
        out += [F.col(k).isNotNull().alias(f"{k}_available"), no("usable_for_daily_max").alias(f"{k}_usable_for_daily_max"), f("newer_run_arriving").alias(f"{k}_newer_run_arriving"), f("usable_run").alias(f"{k}_run"), f("usable_since").alias(f"{k}_usable_since"), f("age_hours").alias(f"{k}_age_hours"), f("tmax").alias(f"{k}_forecast_tmax_f"), f("previous_run").alias(f"{k}_previous_run"), f("previous_tmax").alias(f"{k}_previous_forecast_tmax_f"), f("revision").alias(f"{k}_revision_f"), f("seen_run").alias(f"{k}_latest_seen_run"), f("seen_status").alias(f"{k}_latest_seen_status")]
    e = parts.ensemble().select("state_id", F.struct("*").alias("e"))
    g = lambda c: F.col(f"gefs.{c}")
    out += [F.col("gefs").isNotNull().alias("gefs_available"), F.coalesce(g("usable_for_daily_max"), F.lit(False)).alias("gefs_usable_for_daily_max"), g("usable_run").alias("gefs_run"), g("usable_since").alias("gefs_usable_since"), g("age_hours").alias("gefs_age_hours"), *[F.col(f"e.{c}").alias(f"gefs_tmax_{c}_f") for c in ENSEMBLE], F.col("e.revision_mean").alias("gefs_revision_mean_f"), g("seen_run").alias("gefs_latest_seen_run"), F.col("e.members").alias("gefs_member_count_available")]
    have = parts.stations.columns
    seen = _by(parts.stations, "station_id", STATIONS, [c for c in have if c not in ("state_id", "station_id")])
    of = lambda n, c: F.col(f"{n}.{c}") if c in have else F.lit(None).cast("double")
    for n in STATIONS.values():
        out += [F.coalesce(of(n, "available"), F.lit(False)).alias(f"{n}_available"), of(n, "current_f").alias(f"{n}_current_temp_f"), of(n, "current_dewpoint_f").alias(f"{n}_current_dewpoint_f"), of(n, "current_wind_speed_ms").alias(f"{n}_current_wind_speed_ms"), of(n, "current_station_pressure_hpa").alias(f"{n}_current_pressure_hpa"), of(n, "tmax_so_far_f").alias(f"{n}_tmax_so_far_f"), F.timestamp_micros(of(n, "time_of_max_us")).alias(f"{n}_time_of_tmax_so_far"), of(n, "age_minutes").alias(f"{n}_observation_age_minutes"), F.timestamp_micros(of(n, "latest_us")).alias(f"{n}_latest_observation_time_utc"), of(n, "stale").alias(f"{n}_observation_stale")]
    out += [(of("KNYC", "current_f") - of(n, "current_f")).alias(f"knyc_minus_{n.lower()}_temp_f") for n in ("KLGA", "KJFK", "KEWR")]
    c = parts.comparison().select("state_id", F.struct("forecast_count", "mean", "median", "std", "range").alias("c"))
    out += [F.col("c.forecast_count").alias("cross_model_forecast_count"), *[F.col(f"c.{x}").alias(f"cross_model_{x}_tmax_f") for x in ("mean", "median", "std", "range")]]
    out += [F.col("latest").isNotNull().alias("afd_available"), F.timestamp_micros("latest.at").alias("afd_issuance_time"), ((F.col("t") - F.col("latest.at")) / 3.6e9).alias("afd_age_hours"), F.col("latest.product_id").alias("afd_product_id")]
    whole = key
    for part in (runs, e, seen, c, parts.texts):
        whole = whole.join(part, "state_id", "left")
    return whole.select(*out)


def audit_facts(parts: Parts) -> DataFrame:
    """(state_id, query_time, a struct per source, {station}_time, afd_time): what a state claims to have known, and when it was there.

    A source's struct has run_time and available_time of the newest run seen, the usable one and the one before, and
    whether the usable one was complete by then. An available time is that of the run's first row of the day, a usable
    run's that of its last.
    """
    roles = {"seen": ("latest_seen", "first_in_day"), "usable": ("latest_usable", "usable_since"), "previous": ("previous_usable", "usable_since")}
    chosen = parts.chosen.join(parts.states.select("state_id", "day", "query_time"), "state_id")
    there = parts.values.groupBy("state_id", "source").agg(*[F.max(F.when(F.col("role") == r, F.col(c))).alias(f"{name}_available_time") for r, (name, c) in roles.items()])
    done = parts.full.select("source", "day", F.col("run_time").alias("usable_run"), "complete_at")
    facts = chosen.join(there, ["state_id", "source"], "left").join(done, ["source", "day", "usable_run"], "left")
    facts = facts.select("state_id", "source", *[F.col(f"{r}_run").alias(f"{name}_run_time") for r, (name, _) in roles.items()], *[f"{name}_available_time" for name, _ in roles.values()], (F.col("complete_at") <= F.col("query_time")).alias("complete"))
    runs = _by(facts, "source", {k: k for k in audit.SOURCES}, [c for c in facts.columns if c not in ("state_id", "source")])
    seen = parts.stations.filter("available").groupBy("state_id").agg(*[F.max(F.when(F.col("station_id") == k, F.timestamp_micros("latest_us"))).alias(f"{n}_time") for k, n in STATIONS.items()])
    texts = parts.texts.select("state_id", F.timestamp_micros("latest.at").alias("afd_time"))
    whole = parts.states.select("state_id", "day", "local_hour", "mode", "query_time")
    for part in (runs, seen, texts):
        whole = whole.join(part, "state_id", "left")
    return whole


def highest_so_far(parts: Parts) -> DataFrame:
    """(state_id, highest_so_far_f): over stations whose latest report is fresh."""
    return parts.stations.groupBy("state_id").agg(F.max(F.when(F.col("available"), F.col("tmax_so_far_f"))).alias("highest_so_far_f"))


def forecast_trajectories(parts: Parts) -> DataFrame:
    """The usable runs' temperatures within the day, as far as known."""
    return pit.temperature_rows(_of_usable(parts, MODELS)).select("state_id", "source", "run_time", "valid_time", "forecast_hour", F.col("value_f").alias("temperature_f"))


def gefs_members(parts: Parts) -> DataFrame:
    return parts.maxima.select("state_id", "run_time", "ensemble_member", F.col("daily_max").alias("member_daily_max_f"))


def _usable(parts: Parts, sources: tuple[str, ...]) -> DataFrame:
    """(state_id, source, run_time, day, query_time) of the usable runs."""
    picks = parts.chosen.filter(F.col("source").isin(*sources) & F.col("usable_run").isNotNull()).select("state_id", "source", F.col("usable_run").alias("run_time"))
    return picks.join(parts.states.select("state_id", "day", "query_time"), "state_id")


def _of_usable(parts: Parts, sources: tuple[str, ...]) -> DataFrame:
    """All variables of the chosen runs within the day, as far as known at the state's time."""
    rows = pit.in_day(parts.forecasts.filter(F.col("available_time").isNotNull()), parts.days)
    return small(_usable(parts, sources)).join(rows, ["source", "run_time", "day"]).filter(F.col("available_time") <= F.col("query_time"))


SHOWN = ["variable", "level", "valid_time", "forecast_hour", "value", "units", "temporal_stat", "temporal_window_hours"]


def atmospheric_trajectories(parts: Parts) -> DataFrame:
    wanted = F.when(F.col("source") == "ecmwf_deterministic", pit.TEMPERATURE["ecmwf_deterministic"]).otherwise("TMP")
    return _of_usable(parts, MODELS).filter(F.col("variable") != wanted).select("state_id", "source", "run_time", *SHOWN)


def gefs_member_trajectories(parts: Parts) -> DataFrame:
    return _of_usable(parts, ("gefs",)).select("state_id", "run_time", "ensemble_member", "member_type", *SHOWN)


def _remaining(parts: Parts) -> DataFrame:
    """(state_id, source, remaining): the usable run's path from the state's time on, by time; empty if all of it is past.

    A run's points are gathered once, as parcels of what arrives between the same query times; states take parcels.
    """
    local = F.from_utc_timestamp("valid_time", times.ZONE)
    rows = pit.with_until(pit.in_day(pit.temperature_rows(parts.forecasts).filter(F.col("source").isin(*MODELS)), parts.days), parts.states)
    point = F.struct((F.hour(local) + F.minute(local) / 60).alias("local_hour"), F.bround("value_f", 2).alias("temp_f"))
    parcels = rows.groupBy("source", "run_time", "day", "valid_time", "forecast_hour", "until").agg(F.collect_list(point).alias("points"))
    known = small(_usable(parts, MODELS)).join(parcels, ["source", "run_time", "day"]).filter(F.col("until") <= F.unix_micros("query_time"))
    ahead = F.collect_list(F.when(F.col("valid_time") >= F.col("query_time"), F.col("points")))
    hours = known.groupBy("state_id", "source", "valid_time", "forecast_hour").agg(F.sort_array(F.flatten(ahead)).alias("x"))
    path = F.sort_array(F.collect_list(F.struct("valid_time", "forecast_hour", "x")))
    return hours.groupBy("state_id", "source").agg(path.alias("r")).select("state_id", "source", F.flatten(F.col("r.x")).alias("remaining"))


def weather_input(parts: Parts) -> DataFrame:
    """(state_id, input): what a model reads, as one JSON document; numbers to two places, half to even."""
    r2 = lambda c: F.bround(c, 2)
    s = parts.states
    target = F.struct(F.col("day").cast("string").alias("target_date"), F.date_format("query_time", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("state_time_utc"), F.col("local_hour"), r2(times.day_progress(F.col("query_time"), F.col("day"))[1]).alias("hours_remaining_in_day"))
    path = _remaining(parts)
    m = parts.runs.filter(F.col("source").isin(*MODELS)).join(path, ["state_id", "source"], "left")
    m = m.select("state_id", "source", F.struct(F.lit(True).alias("available"), "usable_for_daily_max", r2(F.col("tmax")).alias("predicted_daily_max_f"), r2(F.col("previous_tmax")).alias("previous_predicted_daily_max_f"), r2(F.col("revision")).alias("revision_f"), F.bround(F.col("age_hours") * 60, 1).alias("forecast_age_minutes"), F.date_format("usable_run", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("run_time"), F.col("remaining").alias("remaining_target_day_trajectory"), "newer_run_arriving").alias("m"))
    models = m.groupBy("state_id").agg(F.map_from_entries(F.collect_list(F.struct("source", "m"))).alias("models"))
    st = parts.stations.select("state_id", F.coalesce(*[F.when(F.col("station_id") == k, F.lit(v)) for k, v in STATIONS.items()], F.col("station_id")).alias("k"), F.struct("available", r2(F.col("current_f")).alias("latest_temperature_f"), r2(F.when(F.col("available"), F.col("tmax_so_far_f"))).alias("max_so_far_f"), F.when(F.col("available"), F.bround("age_minutes", 1)).alias("observation_age_minutes"), r2(F.col("change_previous_f")).alias("temperature_change_previous_observation_f"), r2(F.col("change_1h_f")).alias("temperature_change_approx_1h_f")).alias("v"), "available", "current_f", "tmax_so_far_f")
    stations = st.groupBy("state_id").agg(F.struct(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("stations"), r2(F.max(F.when(F.col("available"), F.col("tmax_so_far_f")))).alias("highest_temperature_so_far_f"), r2(F.max("current_f") - F.min("current_f")).alias("current_temperature_range_f")).alias("observations"))
    e = parts.ensemble().select("state_id", F.struct("members", *[r2(F.col(c)).alias(c) for c in (*ENSEMBLE, "revision_mean", "revision_median")]).alias("gefs"))
    pair = F.map_from_entries(F.transform("pairs", lambda p: F.struct(p["pair"], r2(p["difference"]))))
    c = parts.comparison().select("state_id", F.struct("forecast_count", *[r2(F.col(x)).alias(f"forecast_{x}_f") for x in ("mean", "median", "min", "max", "range", "std")], pair.alias("pairwise_disagreement_f")).alias("cross_model"))
    one = text.sections(parts.bulletins, "raw_text", ["product_id"]).filter(text.is_relevant(F.col("section_name"))).groupBy("product_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "section_name", "section_text"))), lambda x: F.struct(x["section_name"].alias("section_name"), x["section_text"].alias("section_text"))).alias("sections"), F.sum(F.length("section_text")).alias("n"))
    b = parts.texts.filter("latest is not null").select("state_id", "t", F.col("latest.product_id").alias("product_id"), F.col("latest.at").alias("at")).join(one, "product_id", "left")
    b = b.select("state_id", F.struct(F.lit(True).alias("available"), "product_id", F.date_format(F.timestamp_micros("at"), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("issuance_time"), F.bround((F.col("t") - F.col("at")) / 6e7, 1).alias("age_minutes"), "sections", F.bround(F.col("n") / 4).cast("long").alias("approx_token_count_selected")).alias("afd"))
    whole = s.select("state_id", target.alias("target"))
    for part in (models, stations, e, c, b):
        whole = whole.join(part, "state_id", "left")
    return whole.select("state_id", F.to_json(F.struct("target", "observations", "models", "gefs", "cross_model", "afd")).alias("input"))


def size_audit(inputs: DataFrame) -> DataFrame:
    """(n, mean, max of the documents' lengths and approximate tokens)"""
    n: Column = F.length("input")
    return inputs.agg(F.count("*").alias("n"), F.avg(n).alias("mean_chars"), F.max(n).alias("max_chars"), F.max(F.floor(n / 4)).alias("max_tokens"))
