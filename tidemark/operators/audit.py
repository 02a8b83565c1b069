"""Data-quality checks. Each is a query of violations: no rows, no violation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Parts of a column name that suggest the outcome leaked into the features.
SUSPICIOUS = ("settlement", "result", "future", "actual", "final_high", "next_day")


def missingness(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """(by, column, missing_pct): one pass, then unpivoted."""
    g = df.groupBy(*by).agg(*[(100 * F.avg(F.col(c).isNull().cast("int"))).alias(c) for c in columns])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing_pct")) for c in columns])).alias("x")
    return g.select(*by, pairs).select(*by, "x.*")


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def lookahead(df: DataFrame, query_time: str, known: list[str]) -> DataFrame:
    """Rows in which something became known only after it was used; ``known``: time columns."""
    late = F.array_compact(F.array(*[F.when(F.col(c) > F.col(query_time), c) for c in known]))
    return df.withColumn("late", late).filter(F.size("late") > 0)


def wrong_counts(states: DataFrame, day: str, mode: str, per_mode: int) -> DataFrame:
    """Days that don't have ``per_mode`` states under each policy."""
    return states.groupBy(day).agg(F.count("*").alias("n"), F.count(F.when(F.col(mode) == "strict", 1)).alias("n_strict"), F.count(F.when(F.col(mode) == "proxy", 1)).alias("n_proxy")).filter((F.col("n_strict") != per_mode) | (F.col("n_proxy") != per_mode) | (F.col("n") != 2 * per_mode))


def not_a_prefix(days: DataFrame, day: str, has: Column) -> DataFrame:
    """Days that have a label although an earlier one has none. The first missing day is one minimum, not a sort."""
    first = days.filter(~has).agg(F.min(day).alias("first_missing"))
    return days.filter(has).join(F.broadcast(first), F.col(day) > F.col("first_missing"))  # one row is broadcast


def varying(df: DataFrame, by: list[str], column: str) -> DataFrame:
    """Groups in which a value that should be one differs."""
    return df.groupBy(*by).agg(F.countDistinct(column).alias("n_values")).filter("n_values > 1")


def above(df: DataFrame, value: str, limit: str) -> DataFrame:
    """Rows whose running value exceeds what it can at most become."""
    return df.filter(F.col(value) > F.col(limit))


def low_rates(df: DataFrame, by: list[str], usable: str, least: float) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(F.col(usable).cast("int")).alias("rate")).filter(F.col("rate") <= least)


def exposed(df: DataFrame, mode: str, columns: list[str]) -> DataFrame:
    """Strict rows that show what only the proxy policy may."""
    shown = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), c) for c in columns]))
    return df.filter(F.col(mode) == "strict").withColumn("shown", shown).filter(F.size("shown") > 0)


def too_young(df: DataFrame, age_hours: str, least: float) -> DataFrame:
    return df.filter(F.col(age_hours) < least)


def without_detail(states: DataFrame, usable: str, detail: DataFrame, keys: list[str]) -> DataFrame:
    """Usable rows for which the detail table has nothing."""
    return states.filter(F.col(usable)).join(detail.select(*keys).distinct(), keys, "left_anti")


def wrong_member_counts(states: DataFrame, detail: DataFrame, keys: list[str], member: str, expected: int) -> DataFrame:
    n = detail.groupBy(*keys).agg(F.countDistinct(member).alias("n"))
    return states.join(n, keys, "left").filter(F.coalesce("n", F.lit(0)) != expected)


def policies_differ(df: DataFrame, by: list[str], mode: str, value: str) -> DataFrame:
    """Where both policies should read the same value and don't; a conditional sum instead of a self-join."""
    side = lambda m: F.max(F.when(F.col(mode) == m, F.col(value)))
    return df.groupBy(*by).agg(side("strict").alias("strict"), side("proxy").alias("proxy")).filter(~F.col("strict").eqNullSafe(F.col("proxy")))


def leakage_columns(spark: SparkSession, df: DataFrame, parts: tuple = SUSPICIOUS) -> DataFrame:
    """Column names that contain a suspicious part: the schema alone is read."""
    found = [(c,) for c in df.columns if any(p in c.lower() for p in parts)]
    return spark.createDataFrame(found, "column string")


def changed_row_counts(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose number of rows a rewrite changed."""
    a, b = before.groupBy(*keys).agg(F.count("*").alias("n_before")), after.groupBy(*keys).agg(F.count("*").alias("n_after"))
    return a.join(b, keys, "full_outer").na.fill(0, ["n_before", "n_after"]).filter("n_before <> n_after")


def inconsistent_hours(df: DataFrame, run: str, valid: str, hour: str) -> DataFrame:
    return df.filter(F.unix_micros(valid) - F.unix_micros(run) != F.col(hour).cast("long") * 3_600_000_000)


def moved_points(first: DataFrame, later: DataFrame, keys: list[str], lat: str, lon: str, degrees: float) -> DataFrame:
    """Grid points that are elsewhere than they were, by more than ``degrees``, or are gone."""
    b = later.select(*keys, F.col(lat).alias("lat_after"), F.col(lon).alias("lon_after"))
    off = (F.abs(F.col(lat) - F.col("lat_after")) > degrees) | (F.abs(F.col(lon) - F.col("lon_after")) > degrees)
    return first.join(b, keys, "left").filter(F.col("lat_after").isNull() | off)


def missing_kind(present: Column, applicable: Column, due: Column) -> Column:
    """Why a value is absent, never a zero in its place."""
    return F.when(present, "PRESENT").when(~applicable, "STRUCTURALLY_NOT_APPLICABLE").when(~due, "NOT_YET_AVAILABLE").otherwise("MISSING_UNEXPECTEDLY")


def unsorted_within(df: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("before", F.lag(value).over(w)).filter(F.col(value) < F.col("before"))


def availability(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n_known, available): whether a field occurs at all; one pass."""
    g = df.agg(*[F.count(c).alias(c) for c in columns])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_known")) for c in columns])).alias("x")
    return g.select(pairs).select("x.column", "x.n_known", (F.col("x.n_known") > 0).alias("available"))


def first_known(df: DataFrame, by: list[str], order: str, columns: list[str]) -> DataFrame:
    """Each column's first value that isn't null: minima by a struct, not a sort."""
    return df.groupBy(*by).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns])


def violations(df: DataFrame, keys: list[str], rules: dict[str, Column]) -> DataFrame:
    """(keys, check_name) for each named rule that a row breaks; all rules in one pass. A rule is true where it is broken; null is no fault."""
    broken = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))
    return df.select(*keys, F.explode(broken).alias("check_name"))


#: Sources and roles whose runs are checked, and how an observation's and a bulletin's check are called.
SOURCES = ("hrrr", "gfs", "nbm", "ecmwf_deterministic", "gefs", "ecmwf_ensemble")
ROLES = ("latest_seen", "latest_usable", "previous_usable")


def state_rules(stations: list[str], t: str = "query_time") -> dict[str, Column]:
    """The named no-lookahead checks of a state: for each source's three runs when they were made and when they were there,
    whether the usable one was complete, each station's report, and the bulletin."""
    rules = {}
    for s in SOURCES:
        for role in ROLES:
            for what in ("run_time", "available_time"):
                rules[f"{s}_{role}_{what}_le_t"] = F.col(f"{s}.{role}_{what}") > F.col(t)
        rules[f"{s}_latest_usable_was_actually_complete"] = F.col(f"{s}.latest_usable_run_time").isNotNull() & ~F.coalesce(F.col(f"{s}.complete"), F.lit(False))
    rules |= {f"observation_{x}_time_le_t": F.col(f"{x}_time") > F.col(t) for x in stations}
    return rules | {"afd_issuance_time_le_t": F.col("afd_time") > F.col(t)}


def fingerprint(points: DataFrame, by: list[str], lat: str, lon: str, digits: int = 6) -> DataFrame:
    """(by, n_points, n_lat, n_lon, fingerprint): what a grid is, whatever the order of its points and however often each is there."""
    at = lambda c: F.round(F.col(c).cast("decimal(18,9)"), digits).cast(f"decimal(12,{digits})")
    d = points.select(*by, at(lat).alias("y"), at(lon).alias("x")).distinct()
    part = F.conv(F.substring(F.md5(F.concat_ws("|", F.col("y").cast("string"), F.col("x").cast("string"))), 1, 15), 16, 10).cast("long")
    return d.groupBy(*by).agg(F.count("*").alias("n_points"), F.countDistinct("y").alias("n_lat"), F.countDistinct("x").alias("n_lon"), F.bit_xor(part).alias("fingerprint"))


def grid_check(reference: DataFrame, later: DataFrame, by: list[str], distance_km: Column, ceiling_km: float = 25.0) -> DataFrame:
    """Compares fingerprints of two runs and the later one's distance to the place wanted: PASS, FLAGGED, or PROBE_FAILED where one is absent."""
    r = reference.select(*by, *[F.col(c).alias(f"r_{c}") for c in ("n_points", "n_lat", "n_lon", "fingerprint")])
    d = r.join(later.withColumn("distance_km", distance_km), by, "full_outer")
    same = F.col("r_fingerprint") == F.col("fingerprint")
    dims = (F.col("r_n_lat") == F.col("n_lat")) & (F.col("r_n_lon") == F.col("n_lon")) & (F.col("r_n_points") == F.col("n_points"))
    near = F.coalesce(F.col("distance_km") < ceiling_km, F.lit(False))
    status = F.when(F.col("r_fingerprint").isNull() | F.col("fingerprint").isNull(), "PROBE_FAILED").when(same & dims & near, "PASS").otherwise("FLAGGED_FOR_INVESTIGATION")
    return d.select(*by, same.alias("fingerprint_match"), dims.alias("dims_match"), near.alias("distance_ok"), status.alias("status"))


def scale(measured: DataFrame, by: list[str], horizons: dict[str, int]) -> DataFrame:
    """What a plan would take if each day went on as measured. ``measured``: by, runs, rows, bytes, seconds, days; one row each.

    (by, horizon, runs, rows, gigabytes, hours)
    """
    days = F.explode(F.array(*[F.struct(F.lit(k).alias("horizon"), F.lit(n).alias("n")) for k, n in horizons.items()])).alias("h")
    m = measured.select("*", days)
    per_day = lambda c: F.col(c) / F.nullif(F.col("days"), F.lit(0)) * F.col("h.n")
    return m.select(*by, F.col("h.horizon").alias("horizon"), per_day("runs").alias("runs"), per_day("rows").alias("rows"), (per_day("bytes") / 1e9).alias("gigabytes"), (per_day("seconds") / 3600).alias("hours"))
