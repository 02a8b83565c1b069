"""States of the world from all sources. Events stand in: models by user, members by kind, stations by user, errors as bulletins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import audit, market, orderbook, pit, states
from tidemark.operators.asof import asof_join, with_predecessor
from tidemark.plans import pit_queries, text_queries
from tidemark.plans.registry import query
from tidemark.sources.sinks import staged
from tidemark.sources.tables import events, table

MODELS = states.MODELS
NAMED = "CASE user_id % 4 WHEN 0 THEN 'hrrr' WHEN 1 THEN 'gfs' WHEN 2 THEN 'nbm' ELSE 'ecmwf_deterministic' END"
STATION = "CASE user_id % 4 WHEN 0 THEN 'KNYC' WHEN 1 THEN 'KLGA' WHEN 2 THEN 'KJFK' ELSE 'KEWR' END"


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a temperature of its model and of the ensemble's member; errors are also humidity rows."""
    e = pit_queries.forecasts(spark, sf_dir)
    place = F.substring("source", 2, 1).cast("int")
    model = F.get(F.array(*map(F.lit, MODELS)), place)

    def rows(d: DataFrame, source: Column, variable: Column, member: Column) -> DataFrame:
        none = F.lit(None).cast("string")
        return d.select(source.alias("source"), "run_time", member.alias("ensemble_member"), none.alias("member_type"), variable.alias("variable"), F.lit("2 m").alias("level"), "forecast_hour", "valid_time", "available_time", "value", F.col("value").alias("value_f"), F.lit("F").alias("units"), F.lit("instant").alias("temporal_stat"), F.lit(None).cast("int").alias("temporal_window_hours"))

    own = F.when(model == "ecmwf_deterministic", "2t").otherwise("TMP")
    no = F.lit(None).cast("string")
    det, ens = rows(e, model, own, no), rows(e, F.lit("gefs"), F.lit("TMP"), F.col("ensemble_member"))
    return det.unionByName(ens).unionByName(rows(e.filter("ensemble_member = 'error'"), model, F.lit("RH"), no))


def schedule(spark: SparkSession) -> DataFrame:
    hours = F.explode(F.sequence(F.lit(0), F.lit(66), F.lit(6))).alias("forecast_hour")
    return spark.range(24).select(F.explode(F.array(*map(F.lit, (*MODELS, "gefs")))).alias("source"), F.col("id").cast("int").alias("run_hour")).select("source", "run_hour", hours)


def parts(spark: SparkSession, sf_dir: str) -> states.Parts:
    e, ts = events(spark, sf_dir), F.col("ts").cast("timestamp")
    station = F.get(F.array(*map(F.lit, states.STATIONS)), (F.col("user_id") % 4).cast("int"))
    obs = e.filter("event_type = 'view'").groupBy(station.alias("station_id"), ts.alias("observation_time")).agg(F.max("value").alias("temperature_f"))
    texts = e.filter("event_type = 'error'").groupBy(ts.alias("issuance_time")).agg(F.min("event_id").cast("string").alias("product_id")).select("product_id", "issuance_time", F.concat(F.lit("HEAD\n.SYNOPSIS...\nnumber "), "product_id", F.lit("\n.MARINE...\ncalm\n")).alias("raw_text"))
    return states.Parts(pit_queries.states(spark, sf_dir), forecasts(spark, sf_dir), obs, texts, schedule(spark), {"gefs": 5})


ENSEMBLE = pit_queries.ROWS.replace("'m' || (user_id % 4)", "'gefs'") + """,
k AS (SELECT s.state_id, s.day, s.t, f.source, f.run_time FROM s JOIN f ON f.avail <= s.t AND f.run_time <= s.t AND f.run_time >= s.t - INTERVAL 3 DAY GROUP BY ALL),
pm AS (SELECT k.state_id, k.source, k.run_time, fd.member, count(DISTINCT fd.valid_time) FILTER (fd.wanted) AS points, max(fd.value) AS mx FROM k JOIN fd ON fd.source = k.source AND fd.run_time = k.run_time AND fd.day = k.day AND fd.avail <= k.t GROUP BY ALL),
ok AS (SELECT pm.state_id, pm.source, pm.run_time FROM pm JOIN s USING (state_id) JOIN n ON n.source = pm.source AND n.run_time = pm.run_time AND n.day = s.day GROUP BY ALL HAVING min(points) = any_value(n.want) AND count(*) = 5),
top AS (SELECT state_id, source, max(run_time) AS run_time FROM ok GROUP BY ALL)"""
#: The states' parts in SQL: o (runs of each model), ge (ensemble), so (stations), b (bulletins), c (comparison).
PARTS = (
    pit_queries.STATE.replace("'m' || (user_id % 4)", NAMED)
    + f""", ge AS (WITH {ENSEMBLE} SELECT state_id, any_value(run_time) AS run, avg(mx) AS me, quantile_cont(mx, 0.5) AS p50, stddev_samp(mx) AS sd, min(mx) AS mn, max(mx) AS mxx, quantile_cont(mx, 0.1) AS p10, quantile_cont(mx, 0.9) AS p90, count(*) AS members FROM top JOIN pm USING (state_id, source, run_time) GROUP BY ALL),
ob AS (SELECT {STATION} AS st, ts, max(value) AS v FROM events WHERE event_type = 'view' GROUP BY ALL),
so AS (SELECT s.state_id, ob.st, max(ob.ts) AS at, arg_max(ob.v, ob.ts) AS v, max(ob.v) FILTER (ob.ts >= s.day_start) AS tmax, epoch_us(any_value(s.t)) - epoch_us(max(ob.ts)) AS age FROM s JOIN ob ON ob.ts <= s.t WHERE s.mode = 'proxy' GROUP BY s.state_id, ob.st),
bl AS (SELECT ts, min(event_id)::VARCHAR AS id FROM events WHERE event_type = 'error' GROUP BY ts),
b AS (SELECT s.state_id, arg_max(bl.id, bl.ts) AS id, epoch_us(any_value(s.t)) - epoch_us(max(bl.ts)) AS age FROM s JOIN bl ON bl.ts <= s.t WHERE s.mode = 'proxy' GROUP BY s.state_id),
x AS (SELECT state_id, tmax FROM o WHERE tmax IS NOT NULL UNION ALL SELECT state_id, p50 FROM ge),
c AS (SELECT state_id, count(*) AS n, avg(tmax) AS me, quantile_cont(tmax, 0.5) AS md, stddev_samp(tmax) AS sd, max(tmax) - min(tmax) AS rg FROM x GROUP BY ALL)"""
)
DETERMINISTIC = ", ".join(
    f"""max(o.state_id) FILTER (o.source = '{k}') IS NOT NULL AS {k}_available, coalesce(bool_or(o.usable IS NOT NULL) FILTER (o.source = '{k}'), false) AS {k}_usable_for_daily_max, bool_or(o.usable IS DISTINCT FROM o.seen) FILTER (o.source = '{k}') AS {k}_newer_run_arriving,
 epoch_us(max(o.usable) FILTER (o.source = '{k}')) AS {k}_run, epoch_us(max(o.since) FILTER (o.source = '{k}')) AS {k}_usable_since, max((epoch_us(o.t) - epoch_us(o.usable)) / 3600000000.0) FILTER (o.source = '{k}') AS {k}_age_hours, max(o.tmax) FILTER (o.source = '{k}') AS {k}_forecast_tmax_f, epoch_us(max(o.previous) FILTER (o.source = '{k}')) AS {k}_previous_run,
 round(max(o.tmax - o.ptmax) FILTER (o.source = '{k}'), 6) AS {k}_revision_f, epoch_us(max(o.seen) FILTER (o.source = '{k}')) AS {k}_latest_seen_run, max(o.seen_status) FILTER (o.source = '{k}') AS {k}_latest_seen_status"""
    for k in MODELS
)
STATIONS = ", ".join(
    f"coalesce(bool_or(so.age <= 21600000000) FILTER (so.st = '{n}'), false) AS {n}_available, max(so.v) FILTER (so.st = '{n}' AND so.age <= 21600000000) AS {n}_current_temp_f, max(so.tmax) FILTER (so.st = '{n}') AS {n}_tmax_so_far_f, max(so.age / 60000000.0) FILTER (so.st = '{n}') AS {n}_observation_age_minutes, bool_or(so.age > 21600000000) FILTER (so.st = '{n}') AS {n}_observation_stale"
    for n in states.STATIONS.values()
)
MODEL_COLUMNS = ("available", "usable_for_daily_max", "newer_run_arriving", "run", "usable_since", "age_hours", "forecast_tmax_f", "previous_run", "revision_f", "latest_seen_run", "latest_seen_status")
STATION_COLUMNS = ("available", "current_temp_f", "tmax_so_far_f", "observation_age_minutes", "observation_stale")


@query(
    PARTS
    + f""", od AS (SELECT s.state_id, {DETERMINISTIC} FROM s LEFT JOIN o ON o.state_id = s.state_id GROUP BY s.state_id), sd AS (SELECT s.state_id, {STATIONS} FROM s LEFT JOIN so ON so.state_id = s.state_id GROUP BY s.state_id)
SELECT s.state_id, strftime(s.day, '%Y-%m-%d') AS target_date, s.mode AS state_mode, s.local_hour::INT AS local_hour, od.* EXCLUDE (state_id), sd.* EXCLUDE (state_id), epoch_us(ge.run) AS gefs_run, round(ge.me, 6) AS gefs_tmax_mean_f, round(ge.p50, 6) AS gefs_tmax_p50_f, round(ge.sd, 6) AS gefs_tmax_std_f, ge.mn AS gefs_tmax_min_f, ge.mxx AS gefs_tmax_max_f, round(ge.p10, 6) AS gefs_tmax_p10_f, round(ge.p90, 6) AS gefs_tmax_p90_f, ge.members AS gefs_member_count_available,
 c.n AS cross_model_forecast_count, round(c.me, 6) AS cross_model_mean_tmax_f, round(c.md, 6) AS cross_model_median_tmax_f, round(c.sd, 6) AS cross_model_std_tmax_f, round(c.rg, 6) AS cross_model_range_tmax_f, b.id AS afd_product_id, b.age / 3600000000.0 AS afd_age_hours
FROM s JOIN od USING (state_id) JOIN sd USING (state_id) LEFT JOIN ge USING (state_id) LEFT JOIN c USING (state_id) LEFT JOIN b USING (state_id)"""
)
def state_wide_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a state from all sources: runs and maxima of each model, ensemble, stations, comparison, bulletin."""
    f = states.structured_features(parts(spark, sf_dir))
    times, rounded = ("run", "usable_since", "previous_run", "latest_seen_run"), ("revision_f",)

    def shown(name: str) -> Column:
        end = name.partition("_")[2] if not name.startswith("ecmwf") else name.removeprefix("ecmwf_deterministic_")
        return (F.unix_micros(name) if end in times else F.round(name, 6) if end in rounded else F.col(name)).alias(name)

    gefs = [F.unix_micros("gefs_run").alias("gefs_run"), *[F.round(f"gefs_tmax_{x}_f", 6).alias(f"gefs_tmax_{x}_f") for x in ("mean", "p50", "std", "p10", "p90")], "gefs_tmax_min_f", "gefs_tmax_max_f", "gefs_member_count_available"]
    cross = ["cross_model_forecast_count", *[F.round(f"cross_model_{x}_tmax_f", 6).alias(f"cross_model_{x}_tmax_f") for x in ("mean", "median", "std", "range")]]
    return f.select("state_id", F.col("target_date").cast("string").alias("target_date"), "state_mode", "local_hour", *[shown(f"{k}_{c}") for k in MODELS for c in MODEL_COLUMNS], *[F.col(f"{n}_{c}") for n in states.STATIONS.values() for c in STATION_COLUMNS], *gefs, *cross, "afd_product_id", "afd_age_hours")


def shown_columns(f: DataFrame) -> list[str]:
    """The columns that ``state_wide_row`` shows of a wide row."""
    gefs = ["gefs_run", *[f"gefs_tmax_{x}_f" for x in ("mean", "p50", "std", "p10", "p90", "min", "max")], "gefs_member_count_available"]
    cross = ["cross_model_forecast_count", *[f"cross_model_{x}_tmax_f" for x in ("mean", "median", "std", "range")]]
    shown = {"state_id", "target_date", "state_mode", "local_hour", *[f"{k}_{c}" for k in MODELS for c in MODEL_COLUMNS], *[f"{n}_{c}" for n in states.STATIONS.values() for c in STATION_COLUMNS], *gefs, *cross, "afd_product_id", "afd_age_hours"}
    return [c for c in f.columns if c in shown]


@query(PARTS + " SELECT o.state_id, o.source, epoch_us(o.usable) AS run_us, epoch_us(fd.valid_time) AS valid_us, fd.fh::INT AS forecast_hour, fd.value AS temperature_f FROM o JOIN s USING (state_id) JOIN fd ON fd.source = o.source AND fd.run_time = o.usable AND fd.day = s.day AND fd.avail <= s.t")
def state_trajectories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The usable runs' temperatures within the day, as far as known."""
    return states.forecast_trajectories(parts(spark, sf_dir)).select("state_id", "source", F.unix_micros("run_time").alias("run_us"), F.unix_micros("valid_time").alias("valid_us"), "forecast_hour", "temperature_f")


@query(PARTS + " SELECT o.state_id, o.source, epoch_us(o.usable) AS run_us, 'RH' AS variable, epoch_us(fd.valid_time) AS valid_us, fd.value FROM o JOIN s USING (state_id) JOIN fd ON fd.source = o.source AND fd.run_time = o.usable AND fd.day = s.day AND fd.avail <= s.t WHERE fd.member = 'error'")
def state_atmosphere(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other variables of the same runs."""
    return states.atmospheric_trajectories(parts(spark, sf_dir)).select("state_id", "source", F.unix_micros("run_time").alias("run_us"), "variable", F.unix_micros("valid_time").alias("valid_us"), "value")


@query(f"WITH {pit_queries.THREE}, {ENSEMBLE} SELECT state_id, epoch_us(run_time) AS run_us, member AS ensemble_member, mx AS member_daily_max_f FROM top JOIN pm USING (state_id, source, run_time)")
def state_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each member's daily maximum in the usable ensemble run."""
    return states.gefs_members(parts(spark, sf_dir)).select("state_id", F.unix_micros("run_time").alias("run_us"), "ensemble_member", "member_daily_max_f")


@query(f"WITH {pit_queries.THREE}, {ENSEMBLE} SELECT state_id, epoch_us(top.run_time) AS run_us, fd.member AS ensemble_member, count(*) AS n, round(sum(fd.value), 4) AS total FROM top JOIN s USING (state_id) JOIN fd ON fd.source = top.source AND fd.run_time = top.run_time AND fd.day = s.day AND fd.avail <= s.t GROUP BY ALL")
def state_member_trajectories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points and sums of every member's path."""
    t = states.gefs_member_trajectories(parts(spark, sf_dir))
    return t.groupBy("state_id", F.unix_micros("run_time").alias("run_us"), "ensemble_member").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query(PARTS + " SELECT state_id, max(tmax) FILTER (age <= 21600000000) AS highest_so_far_f FROM so GROUP BY ALL")
def state_highest_so_far(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The highest temperature of the day so far, over stations whose latest report is fresh."""
    p = parts(spark, sf_dir)
    return states.highest_so_far(p)


@query(
    PARTS
    + """, h AS (SELECT state_id, max(tmax) FILTER (age <= 21600000000) AS hi FROM so GROUP BY ALL), r AS (SELECT state_id, max(tmax) FILTER (source = 'hrrr') AS hrrr, count(*) AS models FROM o GROUP BY ALL)
SELECT s.state_id, s.local_hour::INT AS local_hour, r.models, round_even(r.hrrr, 2) AS hrrr_max_f, round_even(h.hi, 2) AS highest_f, c.n AS forecast_count, b.id AS product_id, CASE WHEN b.id IS NOT NULL THEN 'number ' || b.id END AS synopsis FROM s LEFT JOIN h USING (state_id) LEFT JOIN r USING (state_id) LEFT JOIN c USING (state_id) LEFT JOIN b USING (state_id)"""
)
def state_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the compact documents say, read back out of their JSON."""
    d = states.weather_input(parts(spark, sf_dir))
    kind = "target struct<local_hour:int>, models map<string,struct<predicted_daily_max_f:double>>, observations struct<highest_temperature_so_far_f:double>, cross_model struct<forecast_count:bigint>, afd struct<product_id:string,sections:array<struct<section_text:string>>>"
    j = staged(d.select("state_id", F.from_json("input", kind).alias("j")))  # documents are long: read once, the paths passed over
    models = F.size(F.map_keys("j.models"))
    synopsis = F.get("j.afd.sections", F.lit(0))["section_text"]
    return j.select("state_id", F.col("j.target.local_hour").alias("local_hour"), F.when(models >= 0, models).cast("long").alias("models"), F.try_element_at("j.models", F.lit("hrrr"))["predicted_daily_max_f"].alias("hrrr_max_f"), F.col("j.observations.highest_temperature_so_far_f").alias("highest_f"), F.col("j.cross_model.forecast_count").alias("forecast_count"), F.col("j.afd.product_id").alias("product_id"), F.trim(synopsis).alias("synopsis"))


@query("SELECT CAST(NULL AS VARCHAR) AS state_id, CAST(NULL AS VARCHAR) AS check_name WHERE false")
def dq_state_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audits of the wide rows by name; every one must find nothing."""
    f = states.structured_features(parts(spark, sf_dir))
    proxy_only = [f"{n}_current_temp_f" for n in states.STATIONS.values()] + ["afd_product_id"]
    times = [f"{k}_{c}" for k in MODELS for c in ("usable_since", "run", "previous_run", "latest_seen_run")] + [f"{n}_latest_observation_time_utc" for n in states.STATIONS.values()] + ["gefs_run", "afd_issuance_time"]
    rules = {f"no_lookahead_{c}": F.col(c) > F.col("query_time_utc") for c in times}
    rules |= {f"strict_hides_{c}": (F.col("state_mode") == "strict") & F.col(c).isNotNull() for c in proxy_only}
    rules |= {f"previous_is_older_{k}": F.col(f"{k}_previous_run") > F.col(f"{k}_run") for k in MODELS}
    rules["age_is_not_negative"] = F.col("ecmwf_deterministic_age_hours") < 0.0
    return audit.violations(f, ["state_id"], rules)


@query("SELECT o_orderkey, CASE WHEN coalesce(CASE WHEN o_orderkey % 3 > 0 THEN o_orderdate::DATE END, o_orderdate::DATE + 30) < DATE '1995-01-01' THEN 'historical' ELSE 'live' END AS endpoint FROM orders")
def market_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which feed has a market's candles: settled, or else closed, before the cutoff."""
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select("o_orderkey", market.endpoint(F.when(F.col("o_orderkey") % 3 > 0, day), F.date_add(day, 30), F.lit("1995-01-01").cast("date")).alias("endpoint"))


@query("WITH e AS (SELECT user_id, min(epoch_us(ts)) FILTER (event_type = 'signup') AS first, min(epoch_us(ts)) AS opened, count(DISTINCT event_type) AS n, bool_or(event_type = 'error') AS bad FROM events GROUP BY user_id) SELECT user_id, CASE WHEN first IS NULL OR n = 0 THEN 'INVALID' WHEN n < 5 THEN 'PARTIAL' WHEN (first - opened) / 1e6 <= 60 THEN 'FULL' WHEN (first - opened) / 1e6 <= 600 THEN 'NEAR' ELSE 'STARTED_AFTER_OPEN' END AS opening, CASE WHEN first > opened THEN 'STARTED_MID_EVENT' WHEN bad THEN 'INVALID' WHEN n < 5 THEN 'PARTIAL' ELSE 'COMPLETE' END AS completeness FROM e")
def capture_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well each user's opening was caught, and how complete the capture is."""
    e = events(spark, sf_dir).groupBy("user_id").agg(F.min(F.when(F.col("event_type") == "signup", F.col("us"))).alias("first"), F.min("us").alias("opened"), F.countDistinct("event_type").alias("n"), F.max(F.col("event_type") == "error").alias("bad"))
    return e.select("user_id", orderbook.opening_capture(F.col("first"), F.col("opened"), F.col("n"), F.lit(5)).alias("opening"), orderbook.capture_completeness(F.col("first") > F.col("opened"), F.col("bad"), F.col("n") < 5).alias("completeness"))


@query(f"WITH e AS (SELECT {STATION} AS station, epoch_us(ts) AS us, event_id, value FROM events), g AS (SELECT *, (us - lag(us) OVER (PARTITION BY station ORDER BY us, event_id)) / 60000000.0 AS gap FROM e) SELECT station, count(*) AS n, round(quantile_cont(gap, 0.5), 6) AS median_gap_minutes, round(quantile_cont(gap, 0.9), 6) AS p90_gap_minutes, max(gap) AS max_gap_minutes, count(*) - count(DISTINCT us) AS n_duplicates, round(100.0 * count(*) FILTER (value > 90) / count(*), 6) AS missing_pct FROM g GROUP BY station")
def station_gap_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per station: gaps between reports, repeated times, share of values that are missing (here: above 90)."""
    station = F.get(F.array(*map(F.lit, states.STATIONS.values())), (F.col("user_id") % 4).cast("int"))
    e = events(spark, sf_dir).select(station.alias("station"), "us", "event_id", "value")
    gap = (F.col("us") - F.col("before.us")) / 6e7
    g = with_predecessor(e, ["station"], "us", ["event_id"], to="before").withColumn("gap", gap)
    p = F.expr("percentile(gap, array(0.5, 0.9))")
    out = g.groupBy("station").agg(F.count("*").alias("n"), p.alias("p"), F.max("gap").alias("max_gap_minutes"), (F.count("*") - F.countDistinct("us")).alias("n_duplicates"), F.round(100.0 * F.count(F.when(F.col("value") > 90, 1)) / F.count("*"), 6).alias("missing_pct"))
    return out.select("station", "n", F.round(F.col("p")[0], 6).alias("median_gap_minutes"), F.round(F.col("p")[1], 6).alias("p90_gap_minutes"), "max_gap_minutes", "n_duplicates", "missing_pct")


@query(f"WITH f AS (SELECT {NAMED} AS source, date_trunc('day', ts) AS run, date_trunc('day', ts) + INTERVAL (24 * k + 6 * (hour(ts) // 6)) HOUR AS valid, max(value) AS v FROM events, range(3) AS x(k) GROUP BY ALL) SELECT source, epoch_us(valid) AS valid_us, epoch_us(run) AS run_us, v AS temperature_f, round(v - lag(v) OVER (PARTITION BY source, valid ORDER BY run), 6) AS revision_f FROM f")
def fixed_valid_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the forecast for one valid time changes from run to run; a group has the few runs that reach it."""
    from tidemark.operators.windows import change

    f = pit_queries.forecasts(spark, sf_dir)
    model = F.get(F.array(*map(F.lit, MODELS)), F.substring("source", 2, 1).cast("int"))
    v = f.groupBy(model.alias("source"), "valid_time", "run_time").agg(F.max("value").alias("temperature_f"))
    return change(v, ["source", "valid_time"], ["run_time"], "temperature_f", "revision_f").select("source", F.unix_micros("valid_time").alias("valid_us"), F.unix_micros("run_time").alias("run_us"), "temperature_f", F.round("revision_f", 6).alias("revision_f"))


@query(text_queries.BULLETIN_ALL_SQL + """, names AS (SELECT CASE WHEN position = 0 THEN 'HEADER' ELSE trim(string_split(piece, chr(2))[1]) END AS section_name FROM s WHERE position > 0 OR piece <> '') SELECT section_name, count(*) AS n FROM names GROUP BY ALL ORDER BY n DESC, section_name LIMIT 20""")
def top_section_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty most frequent section names of all bulletins: a report of that length."""
    s = text.sections(text_queries._all_bulletins(spark, sf_dir), "t", ["doc_id"])
    return s.groupBy("section_name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "section_name").limit(20)


SHOWN = ("hrrr_forecast_tmax_f", "KNYC_current_temp_f", "KNYC_tmax_so_far_f", "gefs_tmax_min_f", "gefs_tmax_max_f", "cross_model_forecast_count")


@query(
    PARTS
    + f""", w AS (SELECT s.state_id, s.day, s.local_hour, s.mode, (SELECT max(o.tmax) FROM o WHERE o.state_id = s.state_id AND o.source = 'hrrr') AS hrrr_forecast_tmax_f, (SELECT max(so.v) FROM so WHERE so.state_id = s.state_id AND so.st = 'KNYC' AND so.age <= 21600000000) AS KNYC_current_temp_f, (SELECT max(so.tmax) FROM so WHERE so.state_id = s.state_id AND so.st = 'KNYC') AS KNYC_tmax_so_far_f,
 ge.mn AS gefs_tmax_min_f, ge.mxx AS gefs_tmax_max_f, c.n::DOUBLE AS cross_model_forecast_count FROM s LEFT JOIN ge USING (state_id) LEFT JOIN c USING (state_id))
{" UNION ALL ".join(f"SELECT state_id, '{x}' AS field, {x}::DOUBLE AS value FROM w WHERE mode = 'proxy' AND local_hour = 10 AND {x} IS NOT NULL" for x in SHOWN)}"""
)
def state_inspector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of states, the ten o'clock ones, field by field as an inspector shows them; fields without a value are left out."""
    f = states.structured_features(parts(spark, sf_dir)).filter("state_mode = 'proxy' and local_hour = 10")
    return f.select("state_id", *[F.col(c).cast("double").alias(c) for c in SHOWN]).unpivot(["state_id"], list(SHOWN), "field", "value").filter("value is not null")


@query(f"""WITH {pit_queries.THREE}, {pit_queries.ROWS}, p AS (SELECT source, run_time, day, valid_time, wanted, min(avail) AS tm FROM fd GROUP BY ALL),
r AS (SELECT source, run_time, day, count(*) FILTER (wanted) AS points, max(tm) FILTER (wanted) AS tm FROM p GROUP BY ALL),
ev AS (SELECT n.source, n.run_time, n.day, r.tm FROM n JOIN r USING (source, run_time, day) WHERE points = want)
SELECT ev.source, epoch_us(ev.run_time) AS run_us, strftime(ev.day, '%Y-%m-%d') AS day, epoch_us(ev.tm) AS usable_us, max(epoch_us(s.t)) FILTER (s.t < ev.tm) AS before_us, min(epoch_us(s.t)) FILTER (s.t >= ev.tm) AS after_us FROM ev JOIN s ON s.day = ev.day AND s.mode = 'strict' GROUP BY ALL""")
def event_brackets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each run that became usable for a day: the day's last state before that and the first one after it."""
    days = pit.local_days(pit_queries.days_of(spark, sf_dir))
    done = pit.usable_since_schedule(pit_queries.forecasts(spark, sf_dir), days, pit_queries.schedule(spark), {}).withColumn("usable_us", F.unix_micros("usable_at"))
    at = pit_queries.states(spark, sf_dir).filter("mode = 'strict'").select("day", F.unix_micros("query_time").alias("t"))
    both = asof_join(done, at, ["day"], "usable_us", "t", inclusive=False, to="before")
    both = asof_join(both, at, ["day"], "usable_us", "t", direction="forward", to="after")
    return both.select("source", F.unix_micros("run_time").alias("run_us"), F.col("day").cast("string").alias("day"), "usable_us", F.col("before.t").alias("before_us"), F.col("after.t").alias("after_us"))
