"""What ``state_wide_row`` and ``state_documents`` leave out: the other columns with labels and humidity, and the documents' fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import states
from tidemark.plans import pit_queries, state_queries
from tidemark.plans.registry import query
from tidemark.plans.state_queries import ENSEMBLE, MODELS, PARTS, STATION, parts
from tidemark.sources.sinks import staged
from tidemark.sources.tables import events

NAMES = list(states.STATIONS.values())


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day's outcome at the first station: the highest value, when it was first reached, how many reports there were, and if these are enough."""
    days = pit_queries.pit.local_days(pit_queries.days_of(spark, sf_dir))
    e = events(spark, sf_dir).filter("event_type = 'view' and user_id % 4 = 0").select(F.col("ts").cast("timestamp").alias("valid_time"), "us", "value")
    g = pit_queries.pit.in_day(e, days).groupBy("day").agg(F.max("value").alias("label_tmax_f"), F.max_by(-F.col("us"), F.struct("value", -F.col("us"))).alias("at"), F.count("*").alias("label_observation_count"))
    return g.select("day", "label_tmax_f", (-F.col("at")).alias("label_time_of_max_us"), "label_observation_count", F.when(F.col("label_observation_count") >= 12, "OK").otherwise("SPARSE").alias("label_quality"))


def with_more(p: states.Parts, spark: SparkSession, sf_dir: str) -> states.Parts:
    """The parts, with stations that report humidity, wind and pressure too."""
    station = F.get(F.array(*map(F.lit, states.STATIONS)), (F.col("user_id") % 4).cast("int"))
    v = F.max("value")
    obs = events(spark, sf_dir).filter("event_type = 'view'").groupBy(station.alias("station_id"), F.col("ts").cast("timestamp").alias("observation_time")).agg(v.alias("temperature_f"), (v / 2).alias("dewpoint_f"), (v / 8).alias("wind_speed_ms"), (v + 900).alias("station_pressure_hpa"))
    p.stations = states.observations.state(obs, p.states.filter("mode = 'proxy'"), ["station_id"])
    return p


FIRST = f"""ob2 AS (SELECT s.state_id, ob.st, min(ob.ts) AS at FROM s JOIN ob ON ob.ts <= s.t AND ob.ts >= s.day_start JOIN so ON so.state_id = s.state_id AND so.st = ob.st AND so.tmax = ob.v WHERE s.mode = 'proxy' GROUP BY ALL),
lb AS (SELECT d.day, max(e.value) AS tmax, arg_max(-epoch_us(e.ts), (e.value, -epoch_us(e.ts))) AS at, count(*) AS n FROM events e JOIN d ON e.ts >= d.day_start AND e.ts < d.day_end WHERE e.event_type = 'view' AND {STATION} = 'KNYC' GROUP BY d.day),
gs AS (WITH {ENSEMBLE} SELECT state_id, max(run_time) AS seen FROM k GROUP BY ALL),
gu AS (WITH {ENSEMBLE} SELECT state_id, max(fd.avail) AS since FROM top JOIN s USING (state_id) JOIN fd ON fd.source = top.source AND fd.run_time = top.run_time AND fd.day = s.day AND fd.avail <= s.t GROUP BY ALL),
gq AS (WITH {ENSEMBLE} SELECT state_id, quantile_cont(mx, 0.25) AS p25, quantile_cont(mx, 0.75) AS p75, avg(mx) AS me FROM top JOIN pm USING (state_id, source, run_time) GROUP BY ALL),
gp AS (WITH {ENSEMBLE}, sec AS (SELECT ok.state_id, ok.source, max(ok.run_time) AS run_time FROM ok JOIN top USING (state_id, source) WHERE ok.run_time < top.run_time GROUP BY ALL) SELECT state_id, avg(mx) AS me FROM sec JOIN pm USING (state_id, source, run_time) GROUP BY ALL)"""
OF_STATION = ", ".join(f"max({x}) FILTER (so.st = '{n}'{' AND so.age <= 21600000000' if fresh else ''}) AS {n}_{c}" for n in NAMES for c, x, fresh in (("current_dewpoint_f", "so.v / 2", 1), ("current_wind_speed_ms", "so.v / 8", 1), ("current_pressure_hpa", "so.v + 900", 1), ("time_of_tmax_so_far", "epoch_us(ob2.at)", 0), ("latest_observation_time_utc", "epoch_us(so.at)", 0), ("now", "so.v", 1)))


@query(PARTS + f""", {FIRST}, st AS (SELECT s.state_id, {OF_STATION} FROM s LEFT JOIN so ON so.state_id = s.state_id LEFT JOIN ob2 ON ob2.state_id = so.state_id AND ob2.st = so.st GROUP BY s.state_id),
pr AS (SELECT s.state_id, {", ".join(f"max(o.ptmax) FILTER (o.source = '{k}') AS {k}_previous_forecast_tmax_f" for k in MODELS)} FROM s LEFT JOIN o ON o.state_id = s.state_id GROUP BY s.state_id)
SELECT s.state_id, epoch_us(s.t) AS query_time_utc, epoch_us(s.day::TIMESTAMP) + s.local_hour * 3600000000 AS query_time_local, dayofyear(s.day)::INT AS day_of_year, month(s.day)::INT AS month, round((epoch_us(s.day_end) - epoch_us(s.t)) / 3600000000.0, 6) AS hours_until_end_of_local_day,
lb.tmax AS label_tmax_f, -lb.at AS label_time_of_max_us, lb.n AS label_observation_count, CASE WHEN lb.n >= 12 THEN 'OK' WHEN lb.n > 0 THEN 'SPARSE' END AS label_quality, pr.* EXCLUDE (state_id),
gs.seen IS NOT NULL AS gefs_available, ge.run IS NOT NULL AS gefs_usable_for_daily_max, epoch_us(gu.since) AS gefs_usable_since, round((epoch_us(s.t) - epoch_us(ge.run)) / 3600000000.0, 6) AS gefs_age_hours, round(gq.p25, 6) AS gefs_tmax_p25_f, round(gq.p75, 6) AS gefs_tmax_p75_f, round(gq.me - gp.me, 6) AS gefs_revision_mean_f, epoch_us(gs.seen) AS gefs_latest_seen_run,
st.* EXCLUDE (state_id, {", ".join(f"{n}_now" for n in NAMES)}), {", ".join(f"round(KNYC_now - {n}_now, 6) AS knyc_minus_{n.lower()}_temp_f" for n in NAMES[1:])}, b.id IS NOT NULL AS afd_available, epoch_us(s.t) - b.age AS afd_issuance_time
FROM s JOIN st USING (state_id) JOIN pr USING (state_id) LEFT JOIN lb ON lb.day = s.day LEFT JOIN gs USING (state_id) LEFT JOIN gu USING (state_id) LEFT JOIN gq USING (state_id) LEFT JOIN gp USING (state_id) LEFT JOIN ge USING (state_id) LEFT JOIN b USING (state_id)""")  # fmt: skip
def state_wide_row_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide row's other columns: calendar, labels, previous maxima, the rest of the ensemble, humidity, wind and pressure, differences between stations, the bulletin's time."""
    f = states.structured_features(with_more(parts(spark, sf_dir), spark, sf_dir), labels(spark, sf_dir))
    shown = set(state_queries.shown_columns(f))
    out = []
    for c, kind in f.dtypes:
        if c not in shown:
            out.append((F.unix_micros(c) if kind == "timestamp" else F.round(c, 6) if kind == "double" else F.col(c)).alias(c))
    return f.select("state_id", *out)


FIELDS = " UNION ALL ".join(
    [f"SELECT o.state_id, 'models.{k}.{c}' AS field, {x} AS value FROM o WHERE source = '{k}' AND usable IS NOT NULL AND {y} IS NOT NULL" for k in MODELS for c, x, y in (("predicted_daily_max_f", "round_even(tmax, 2)", "tmax"), ("previous_predicted_daily_max_f", "round_even(ptmax, 2)", "ptmax"), ("revision_f", "round_even(tmax - ptmax, 2)", "ptmax"), ("forecast_age_minutes", "round_even((epoch_us(t) - epoch_us(usable)) / 60000000.0, 1)", "usable"))]
    + [f"SELECT state_id, 'stations.{n}.{c}', {x} FROM so WHERE st = '{n}' AND age <= 21600000000 AND {x} IS NOT NULL" for n in NAMES for c, x in (("latest_temperature_f", "round_even(v, 2)"), ("max_so_far_f", "round_even(tmax, 2)"), ("observation_age_minutes", "round_even(age / 60000000.0, 1)"))]
    + [f"SELECT a.state_id, 'pairs.{x}_minus_{y}', round_even(a.tmax - b.tmax, 2) FROM z5 a JOIN z5 b USING (state_id) WHERE a.source = '{x}' AND b.source = '{y}'" for i, x in enumerate(states.ORDER) for y in states.ORDER[i + 1 :]]
)


@query(PARTS + f", z5 AS (SELECT state_id, source, tmax FROM o WHERE tmax IS NOT NULL UNION ALL SELECT state_id, 'gefs_median', p50 FROM ge) {FIELDS}")
def state_document_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every number of the documents' models, stations and pairs of models, read back out of their JSON."""
    d = states.weather_input(parts(spark, sf_dir))
    model, station = "predicted_daily_max_f double, previous_predicted_daily_max_f double, revision_f double, forecast_age_minutes double", "latest_temperature_f double, max_so_far_f double, observation_age_minutes double"
    kind = ", ".join(["models map<string,struct<" + model.replace(" double", ":double").replace(", ", ",") + ">>", "observations struct<stations:map<string,struct<" + station.replace(" double", ":double").replace(", ", ",") + ">>>", "cross_model struct<pairwise_disagreement_f:map<string,double>>"])
    j = staged(d.select("state_id", F.from_json("input", kind).alias("j")))

    def fields(prefix: str, entries, names: list[str]) -> DataFrame:
        e = j.select("state_id", F.explode(entries).alias("k", "v"))
        return e.select("state_id", F.explode(F.array(*[F.struct(F.concat(F.lit(f"{prefix}."), "k", F.lit(f".{c}")).alias("field"), F.col(f"v.{c}").alias("value")) for c in names])).alias("x")).select("state_id", "x.*")

    names = lambda s: [x.split()[0] for x in s.split(", ")]
    pairs = j.select("state_id", F.explode("j.cross_model.pairwise_disagreement_f").alias("k", "value")).select("state_id", F.concat(F.lit("pairs."), "k").alias("field"), "value")
    every = fields("models", F.col("j.models"), names(model)).unionByName(fields("stations", F.col("j.observations.stations"), names(station))).unionByName(pairs)
    return every.filter("value is not null")
