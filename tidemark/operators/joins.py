"""Joins with a promise: validated lookups, bucketed intervals, calendars with zero days, nearest points, set differences."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import windows
from tidemark.sources.sinks import staged

#: A side is broadcast only if it is counted to have at most this many rows.
BROADCAST_ROWS = 200_000
EARTH_KM = 6371.0


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, marked for broadcast if it is small; the count stops at the bound."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def lookup(left: DataFrame, right: DataFrame, on: list[str], columns: list[str]) -> DataFrame:
    """Left join to a side that must have one row a key: a second row stops the job instead of multiplying rows."""
    one = right.groupBy(*on).agg(F.count("*").alias("__n"), F.any_value(F.struct(*columns)).alias("__x"))
    checked = F.when(F.col("__n") > 1, F.raise_error(F.lit(f"several rows for one key of {on}"))).otherwise(F.col("__x"))
    right = one.select(*on, checked.alias("__x"))
    return left.join(right, on, "left").select(*left.columns, *[F.col(f"__x.{c}").alias(c) for c in columns])


def duplicates(df: DataFrame, on: list[str]) -> DataFrame:
    """Keys with more than one row."""
    return df.groupBy(*on).agg(F.count("*").alias("n")).filter("n > 1")


def interval_join(points: DataFrame, intervals: DataFrame, at: str, start: str, end: str, width: int, by: list[str] | None = None, how: str = "inner") -> DataFrame:
    """Points in half-open intervals [start, end), all whole numbers.

    Each interval is laid into the buckets of ``width`` that it meets (so this suits intervals of a few widths at most),
    and both sides meet by bucket: an equality join, not a comparison of all with all.
    """
    by = by or []
    p = points.withColumn("__b", F.floor(F.col(at) / width))
    spread = F.explode(F.sequence(F.floor(F.col(start) / width), F.floor((F.col(end) - 1) / width)))
    r = intervals.filter(F.col(start) < F.col(end)).select(*[F.col(c).alias(f"__{c}") for c in by], *[c for c in intervals.columns if c not in by], spread.alias("__rb"))
    on = (F.col("__b") == F.col("__rb")) & (F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))
    for c in by:
        on = on & (F.col(c) == F.col(f"__{c}"))
    return p.join(r, on, how).drop("__b", "__rb", *[f"__{c}" for c in by])


def interval_counts(points: DataFrame, intervals: DataFrame, at: str, start: str, end: str, key: str) -> DataFrame:
    """(key, n): how many points lie in a key's half-open intervals [start, end), whole numbers; keys without any go.

    Points and ends of intervals are put in order together, and the points up to each end counted by a running sum: no
    pair of a point and an interval is made, so the work grows with the rows, not with what lies in an interval.
    """
    sides = F.array(F.struct(F.col(start).alias("t"), F.lit(-1).alias("sign")), F.struct(F.col(end).alias("t"), F.lit(1).alias("sign")))
    ends = intervals.filter(F.col(start) < F.col(end)).select(F.col(key).alias("k"), F.explode(sides).alias("x")).select("k", "x.t", "x.sign", F.lit(0).cast("long").alias("one"))
    here = points.filter(F.col(at).isNotNull()).select(F.lit(None).cast(ends.schema["k"].dataType).alias("k"), F.col(at).alias("t"), F.lit(None).cast("int").alias("sign"), F.lit(1).cast("long").alias("one"))
    upto = windows.running_sum(ends.unionByName(here), [], ["t", "one"], "one", "upto")  # ends before points of their time
    return upto.filter("sign is not null").groupBy(F.col("k").alias(key)).agg(F.sum(F.col("sign") * F.col("upto")).alias("n")).filter("n > 0")


def with_zero_days(daily: DataFrame, calendar: DataFrame, entities: DataFrame, day: str, counts: list[str]) -> DataFrame:
    """Every entity on every day of the calendar; days without rows have 0."""
    grid = entities.crossJoin(small(calendar))  # the product is the result itself
    keys = [*entities.columns, day]
    return grid.join(daily, keys, "left").select(*keys, *[F.coalesce(c, F.lit(0)).alias(c) for c in counts])


def differences(expected: DataFrame, found: DataFrame, columns: list[str]) -> DataFrame:
    """(…, side): rows only expected (missing) or only found (unexpected); one full outer join."""
    e = expected.select(*columns).distinct().withColumn("__e", F.lit(1))
    f = found.select(*columns).distinct().withColumn("__f", F.lit(1))
    return e.join(f, columns, "full_outer").filter("__e is null or __f is null").select(*columns, F.when(F.col("__f").isNull(), "missing").otherwise("unexpected").alias("side"))


def pairwise(df: DataFrame, by: list[str], name: str, value: str, order: list[str]) -> DataFrame:
    """Differences of all pairs i < j in ``order`` within a group; groups hold one value per name, so they are small."""
    place = F.create_map(*[x for i, s in enumerate(order) for x in (F.lit(s), F.lit(i))])
    g = df.filter(F.col(name).isin(*order)).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(place[F.col(name)].alias("i"), F.col(name).alias("k"), F.col(value).alias("v")))).alias("x"))
    pairs = F.flatten(F.transform("x", lambda a: F.transform(F.filter("x", lambda b: b["i"] > a["i"]), lambda b: F.struct(a["k"].alias("first"), b["k"].alias("second"), (a["v"] - b["v"]).alias("difference")))))
    return g.select(*by, F.explode(pairs).alias("p")).select(*by, "p.*")


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(a))


def lon_180(lon: Column) -> Column:
    """Longitudes of 0 to 360 as -180 to 180."""
    return F.when(lon > 180, lon - 360).otherwise(lon)


#: Grid points that the fullest cell of the first level may hold, and the finest level (0.3 m).
CELL_POINTS, FINEST = 16, 27


def nearest_points(points: DataFrame, grid: DataFrame, key: str, lat: str, lon: str, grid_lat: str, grid_lon: str, cell: float, ceiling_km: float) -> DataFrame:
    """The grid point nearest to each point, within ``ceiling_km``; of several at one distance the least row.

    Cells are 360 degrees over a power of two. A point looks into the four cells around it, so as far as half a cell at
    least. What it finds there counts if it is nearer than the border of these four; else the point looks again among
    cells of twice the size, until it has found one or has looked as far as the ceiling. The first cells have ``cell``
    degrees at most and are divided until the fullest holds few grid points, so that the candidates of a point don't
    grow with the grid; grid points at one place count as one.
    """
    g = staged(grid.filter(F.col(grid_lat).isNotNull() & F.col(grid_lon).isNotNull()).groupBy(grid_lat, grid_lon).agg(F.min(F.struct(*grid.columns)).alias("__g")))
    column = lambda x, c, k: F.pmod(F.floor(F.col(x) / c), F.lit(1 << k))
    k = max(1, math.ceil(math.log2(360 / cell)))
    while k < FINEST:
        c = 360 / (1 << k)
        most = g.groupBy(F.floor(F.col(grid_lat) / c), column(grid_lon, c, k)).count().agg(F.max("count")).first()[0] or 0
        if most <= CELL_POINTS:
            break
        k = min(FINEST, k + max(1, math.ceil(math.log(most / CELL_POINTS, 4))))
    open_, found = points.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()), []
    while True:
        c, last = 360 / (1 << k), k <= 1
        y, x = (F.floor(F.col(v) / c - 0.5) for v in (lat, lon))
        # how far the four cells reach: to their parallels, and to their meridians (great circles at a right angle)
        up = F.least(F.col(lat) - F.col("__y0") * c, (F.col("__y0") + 2) * c - F.col(lat))
        aside = F.least(F.col(lon) - F.col("__x0") * c, (F.col("__x0") + 2) * c - F.col(lon), F.lit(90.0))
        reach = F.lit(math.inf) if last else EARTH_KM * F.least(F.radians(up), F.asin(F.cos(F.radians(lat)) * F.sin(F.radians(aside)))) * (1 - 1e-9)
        four = F.array(*[F.struct((F.col("__y0") + i).alias("y"), F.pmod(F.col("__x0") + j, F.lit(1 << k)).alias("x")) for i in (0, 1) for j in (0, 1)])
        p = open_.withColumns({"__y0": y, "__x0": x}).withColumn("__reach", reach).withColumn("__c", F.explode(F.array_distinct(four))).drop("__y0", "__x0")
        cells = g.withColumns({"__gy": F.floor(F.col(grid_lat) / c), "__gx": column(grid_lon, c, k)}).withColumnsRenamed({grid_lat: "__glat", grid_lon: "__glon"})
        both = p.join(cells, (F.col("__c.y") == F.col("__gy")) & (F.col("__c.x") == F.col("__gx")), "left").withColumn("__km", haversine_km(F.col(lat), F.col(lon), F.col("__glat"), F.col("__glon")))
        best = F.min(F.when(F.col("__km").isNotNull() & (F.col("__km") <= ceiling_km), F.struct("__km", "__g")))
        seen = staged(both.groupBy(key, lat, lon).agg(best.alias("__b"), F.min("__reach").alias("__reach")))
        found.append(seen.filter("__b.__km <= __reach").select(key, "__b.__g.*", F.col("__b.__km").alias("distance_km")))
        open_ = seen.filter(F.coalesce(F.col("__b.__km") > F.col("__reach"), F.col("__reach") < ceiling_km)).select(key, lat, lon)
        if last or open_.isEmpty():
            nearest = F.min_by(F.struct(*grid.columns, "distance_km"), F.struct("distance_km", *grid.columns))
            return reduce(DataFrame.unionByName, found).groupBy(key).agg(nearest.alias("b")).select(key, "b.*")
        k -= 1


def nearest_by_rank(df: DataFrame, by: list[str], order: list[str], middle: Column, wanted: Column) -> DataFrame:
    """Of the wanted rows of each group, the one whose rank is nearest to ``middle`` (the lower rank on ties)."""
    d = windows.ranked(df, by, order).withColumn("__m", middle)
    return d.filter(wanted).groupBy(*by).agg(F.min_by(F.struct(*df.columns, "rank"), F.struct(F.abs(F.col("rank") - F.col("__m")), "rank")).alias("x")).select("x.*")
