"""Sidecar indexes of gridded files: parsing, time windows, which message to fetch, and where it ends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: How a description names its window.
KINDS = {"acc": "accum", "ave": "average", "max": "max", "min": "min"}
#: Rules of choice: the kind of window and its length in hours (None: any, "least": the shortest there is).
RULES = {"instant": ("instant", None), "cumulative_since_start": ("accum", "start"), "windowed_1h": ("accum", 1), "sixhour_window": ("accum", 6), "shortest_window": ("accum", "least"), "period_max": ("max", None), "period_min": ("min", None)}


def index_lines(df: DataFrame, line: str = "value", keys: list[str] | None = None) -> DataFrame:
    """(keys, msg_num, byte_start, run_date, variable, level, forecast_desc, qualifier); lines of fewer than six fields go."""
    p = F.split(F.col(line), ":")
    rest = F.array_join(F.filter(F.slice(p, 7, F.greatest(F.size(p) - 6, F.lit(0))), lambda x: x != ""), ":")
    return df.withColumn("__p", p).filter(F.size("__p") >= 6).select(*(keys or []), F.col("__p")[0].try_cast("int").alias("msg_num"), F.col("__p")[1].try_cast("long").alias("byte_start"), F.regexp_replace(F.col("__p")[2], "^d=", "").alias("run_date"), F.col("__p")[3].alias("variable"), F.col("__p")[4].alias("level"), F.trim(F.col("__p")[5]).alias("forecast_desc"), rest.alias("qualifier"))


def window_of(desc: Column) -> Column:
    """struct(kind, start_hour, end_hour); kind null: an unknown format, which is an error wherever it matters."""
    d = F.trim(desc)
    instant = F.regexp_extract(d, r"^(\d+) hour fcst$", 1)
    g = [F.regexp_extract(d, r"^(\d+)-(\d+) (hour|day) (acc|ave|max|min) fcst$", i) for i in (1, 2, 3, 4)]
    unit = F.when(g[2] == "day", 24).otherwise(1)
    kinds = F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv])
    none = F.lit(None).cast("int")
    point = lambda h: F.struct(F.lit("instant").alias("kind"), none.alias("start_hour"), h.cast("int").alias("end_hour"))
    window = F.struct(F.try_element_at(kinds, g[3]).alias("kind"), (g[0].try_cast("int") * unit).alias("start_hour"), (g[1].try_cast("int") * unit).alias("end_hour"))
    return F.when(d == "anl", point(F.lit(0))).when(instant != "", point(instant.try_cast("int"))).otherwise(window)


def with_byte_end(entries: DataFrame, file: list[str]) -> DataFrame:
    """Each message ends before the next one starts; the last one is open (null)."""
    return entries.withColumn("byte_end", F.lead("byte_start").over(Window.partitionBy(*file).orderBy("msg_num")) - 1)


def first_message(entries: DataFrame, file: list[str], variable: str, level: str) -> DataFrame:
    """The first message of a variable and level in each file."""
    d = with_byte_end(entries, file).filter((F.col("variable") == variable) & (F.col("level") == level))
    rest = [c for c in d.columns if c not in file]
    return d.groupBy(*file).agg(F.min_by(F.struct(*rest), "msg_num").alias("x")).select(*file, "x.*")


def choose_message(entries: DataFrame, file: list[str], variable: str, level: str, forecast_hour: str, rule: str) -> DataFrame:
    """One row per file that has candidates: the chosen message, or why there is none (``error``).

    Candidates end at ``forecast_hour`` (a column) and are no probability products. Equal windows are copies of one
    product and the first is taken; different ones are an error, as is a description that can't be read.
    """
    kind, length = RULES[rule]
    d = with_byte_end(entries, file).filter((F.col("variable") == variable) & (F.col("level") == level)).withColumn("w", window_of(F.col("forecast_desc")))
    hours = F.col("w.end_hour") - F.coalesce("w.start_hour", F.lit(0))
    fits = (F.col("w.kind") == kind) & (F.col("w.end_hour") == F.col(forecast_hour)) & ~F.col("qualifier").contains("prob")
    if length == "start":
        fits = fits & (F.coalesce("w.start_hour", F.lit(0)) == 0)
    elif isinstance(length, int):
        fits = fits & (hours == length)
    d = d.withColumn("hours", hours).withColumn("fits", F.coalesce(fits, F.lit(False)))
    g = d.groupBy(*file).agg(F.min(F.when(F.col("fits"), F.col("hours"))).alias("least"), F.count(F.when(F.col("w.kind").isNull(), 1)).alias("unread"), F.sort_array(F.collect_list(F.when(F.col("fits"), F.struct("msg_num", "byte_start", "byte_end", "hours", F.col("w.start_hour").alias("start_hour"), F.col("w.end_hour").alias("end_hour"))))).alias("all"))
    pool = F.filter("all", lambda x: x["hours"] == F.col("least")) if length == "least" else F.col("all")
    one = F.get(F.col("pool"), F.lit(0))
    windows = F.size(F.array_distinct(F.transform("pool", lambda x: F.struct(x["start_hour"], x["end_hour"]))))
    error = F.when(F.col("unread") > 0, "unreadable description").when(F.size("pool") == 0, "no candidate").when(windows > 1, "ambiguous windows")
    return g.withColumn("pool", pool).select(*file, *[F.when(error.isNull(), one[c]).alias(c) for c in ("msg_num", "byte_start", "byte_end", "start_hour", "end_hour")], error.alias("error"))


def object_key(source: str, run_time: Column, forecast_hour: Column, member: Column | None = None) -> Column:
    """Where a run's files lie in the public archives."""
    day, hour = F.date_format(run_time, "yyyyMMdd"), F.date_format(run_time, "HH")
    two, three = F.lpad(forecast_hour.cast("string"), 2, "0"), F.lpad(forecast_hour.cast("string"), 3, "0")
    if source == "hrrr":
        return F.concat(F.lit("hrrr."), day, F.lit("/conus/hrrr.t"), hour, F.lit("z.wrfsfcf"), two, F.lit(".grib2"))
    if source == "gfs":
        return F.concat(F.lit("gfs."), day, F.lit("/"), hour, F.lit("/atmos/gfs.t"), hour, F.lit("z.pgrb2.0p25.f"), three)
    if source == "nbm":
        return F.concat(F.lit("blend."), day, F.lit("/"), hour, F.lit("/core/blend.t"), hour, F.lit("z.core.f"), three, F.lit(".co.grib2"))
    if source == "gefs":
        return F.concat(F.lit("gefs."), day, F.lit("/"), hour, F.lit("/atmos/pgrb2sp25/"), member, F.lit(".t"), hour, F.lit("z.pgrb2s.0p25.f"), three)
    return F.concat(day, F.lit("/"), hour, F.lit("z/ifs/0p25/oper/"), day, hour, F.lit("0000-"), forecast_hour.cast("string"), F.lit("h-oper-fc.grib2"))


def member_type(member: Column) -> Column:
    return F.when(member.startswith("gec"), "control").when(member.startswith("gep"), "perturbed")


def temporal_keys(step_type: Column, start_step: Column, end_step: Column) -> Column:
    """What a message's own keys say of its time: kind, hours of its window (none for an instant), and both steps."""
    kind = F.when(step_type == "avg", "average").otherwise(step_type)
    return F.struct(kind.alias("temporal_stat"), F.when(kind == "instant", 0).otherwise(end_step - start_step).cast("int").alias("temporal_window_hours"), start_step.alias("start_step"), end_step.alias("end_step"))
