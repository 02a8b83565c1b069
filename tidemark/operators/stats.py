"""Distributions: ensembles, histograms, percent pivots, rank correlation, terciles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import windows
from tidemark.sources.sinks import staged


def percentiles(value: str, points: list[float]) -> Column:
    """Exact, interpolated linearly."""
    return F.expr(f"percentile({value}, array({', '.join(map(str, points))}))")


#: Values of a group that one aggregation buffer may hold; buckets of a round of refinement.
BUFFER, BUCKETS = 100_000, 2048


def _same(by: list[str], left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Joins by the columns ``by``, nulls included; those of the right side go."""
    r = right.withColumnsRenamed({c: f"__k_{c}" for c in by})
    on = [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in by] or [F.lit(True)]
    return left.join(r, on, how).drop(*[f"__k_{c}" for c in by])


def quantiles(df: DataFrame, by: list[str], value: str, points: list[float], buffer: int = BUFFER) -> DataFrame:
    """(by, n, q): exact percentiles of each group, interpolated linearly, whatever a group's size; nulls and NaN don't count.

    Groups of up to ``buffer`` values are aggregated as they are. In larger ones a histogram says in which bucket a rank
    lies, the bucket is divided again, and so on until it holds one value or few: counts only, combined before they are
    sent, and no buffer grows with the group. ``df`` is read several times: stage it if it is more than a table.
    """
    d = df.select(*by, F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    sizes = staged(d.groupBy(*by).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")))
    large = sizes.filter(F.col("n") > buffer)
    plain = d.groupBy(*by).agg(F.count("*").alias("n"), percentiles("v", points).alias("q"))
    if large.isEmpty():
        return plain
    large = staged(large)
    if not by:
        return _refined(d, by, large, points, buffer)
    some = _same(by, d, F.broadcast(large.select(*by)) if large.count() <= BUFFER else large.select(*by), "left_anti")
    return some.groupBy(*by).agg(F.count("*").alias("n"), percentiles("v", points).alias("q")).unionByName(_refined(d, by, large, points, buffer))


def _refined(d: DataFrame, by: list[str], large: DataFrame, points: list[float], buffer: int) -> DataFrame:
    at = [(F.col("n") - 1) * F.lit(p) for p in points]
    ranks = F.array_distinct(F.array(*[f(x).cast("long") for x in at for f in (F.floor, F.ceil)]))
    open_ = staged(large.select(*by, F.explode(ranks).alias("k"), F.lit(0).cast("long").alias("base"), "lo", "hi"))
    found = []
    while not open_.isEmpty():
        spans = open_.select(*by, "base", "lo", "hi").distinct()
        small = spans.count() <= BUFFER
        inside = _same(by, d, F.broadcast(spans) if small else spans).filter(F.col("v").between(F.col("lo"), F.col("hi")))
        half = F.when(F.col("hi") - F.col("lo") == float("inf"), 0.5).otherwise(1.0)  # widths beyond a double
        place = F.least(F.lit(BUCKETS - 1), F.floor(F.try_divide(F.col("v") * half - F.col("lo") * half, F.col("hi") * half - F.col("lo") * half) * BUCKETS))
        counts = inside.groupBy(*by, "base", "lo", "hi", F.coalesce(place, F.lit(0)).alias("b")).agg(F.count("*").alias("c"), F.min("v").alias("least"), F.max("v").alias("most"))
        upto = F.sum("c").over(Window.partitionBy(*by, "base").orderBy("b"))  # at most BUCKETS rows
        cells = counts.withColumn("first", F.col("base") + upto - F.col("c")).select(*by, "base", "first", "c", "least", "most")
        hit = _same([*by, "base"], open_, cells).filter((F.col("k") >= F.col("first")) & (F.col("k") < F.col("first") + F.col("c")))
        hit = staged(hit.select(*by, "k", F.col("first").alias("base"), F.col("least").alias("lo"), F.col("most").alias("hi"), "c"))
        found.append(hit.filter("lo = hi").select(*by, "k", F.col("lo").alias("x")))
        few = hit.filter((F.col("lo") < F.col("hi")) & (F.col("c") <= buffer))
        spans = few.select(*by, "base", "lo", "hi").distinct()
        values = _same(by, d, F.broadcast(spans) if small else spans).filter(F.col("v").between(F.col("lo"), F.col("hi"))).groupBy(*by, "base").agg(F.sort_array(F.collect_list("v")).alias("vs"))
        found.append(staged(_same([*by, "base"], few, values).select(*by, "k", F.get("vs", (F.col("k") - F.col("base")).cast("int")).alias("x"))))
        open_ = hit.filter((F.col("lo") < F.col("hi")) & (F.col("c") > buffer)).select(*by, "k", "base", "lo", "hi")
    known = reduce(DataFrame.unionByName, found).groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("k", "x"))).alias("xs"))

    def between(x: Column) -> Column:
        low, high = F.col("xs")[F.floor(x).cast("long")], F.col("xs")[F.ceil(x).cast("long")]
        return F.when(low == high, low).otherwise((F.ceil(x) - x) * low + (x - F.floor(x)) * high)

    return _same(by, large, known).select(*by, "n", F.array(*[between(x) for x in at]).alias("q"))


def with_quantiles(summed: DataFrame, df: DataFrame, by: list[str], values: dict[str, dict[str, float]]) -> DataFrame:
    """Adds exact percentiles to an aggregation by the same keys. ``values``: column -> {new column: point}. Stage ``df``.

    Where no group has more rows than a buffer may hold (counted here), one aggregation gives them all.
    """
    most = df.groupBy(*by).count().agg(F.max("count")).first()[0] or 0
    if most <= BUFFER:
        real = {value: F.when(~F.isnan(F.col(value).cast("double")), F.col(value)) for value in values}
        q = df.select(*by, *[c.alias(value) for value, c in real.items()]).groupBy(*by).agg(*[percentiles(value, list(names.values())).alias(f"__q{i}") for i, (value, names) in enumerate(values.items())])
        return _same(by, summed, q.select(*by, *[F.col(f"__q{i}")[k].alias(c) for i, names in enumerate(values.values()) for k, c in enumerate(names)]), "left")
    for value, names in values.items():
        q = quantiles(df, by, value, list(names.values()))
        summed = _same(by, summed, q.select(*by, *[F.col("q")[i].alias(c) for i, c in enumerate(names)]), "left")
    return summed


def distribution(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Mean, sample standard deviation (null for one value), extremes and percentiles of each group."""
    g = df.groupBy(*by).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"), percentiles(value, [0.1, 0.25, 0.5, 0.75, 0.9]).alias("p"), F.count(value).alias("n"))
    return g.select(*by, "mean", "std", "min", "max", *[F.col("p")[i].alias(c) for i, c in enumerate(("p10", "p25", "p50", "p75", "p90"))], "n")


def exceedance(df: DataFrame, by: list[str], value: str, limits: list[float]) -> DataFrame:
    """Share of values at or above each limit; one pass for all limits."""
    return df.filter(F.col(value).isNotNull()).groupBy(*by).agg(*[F.avg((F.col(value) >= x).cast("int")).alias(f"share_ge_{x:g}") for x in limits])


def integer_histogram(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Counts by whole number (half to even) and their share of the group."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, F.bround(value).cast("int").alias("whole")).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*by)))


def member_completeness(df: DataFrame, by: list[str], member: str, expected_members: int, points_expected: int, point: str) -> DataFrame:
    """Members there, the poorest one's points, and who is incomplete (sorted; there are few members)."""
    per = df.groupBy(*by, member).agg(F.countDistinct(point).cast("int").alias("points"))
    g = per.groupBy(*by).agg(F.count("*").cast("int").alias("members"), F.min("points").alias("points"), F.array_sort(F.collect_list(F.when(F.col("points") < points_expected, F.col(member)))).alias("incomplete"))
    return g.withColumn("complete", (F.col("members") == expected_members) & (F.col("points") == points_expected))


def percent_pivot(df: DataFrame, by: list[str], kind: str, values: list[str]) -> DataFrame:
    """Counts and row percentages of each of ``values``; a plain conditional sum, so no values are collected first."""
    counts = [F.count(F.when(F.col(kind) == v, 1)).alias(f"n_{v}") for v in values]
    g = df.groupBy(*by).agg(*counts)
    total = sum((F.col(f"n_{v}") for v in values[1:]), F.col(f"n_{values[0]}"))
    return g.select("*", *[(F.lit(100.0) * F.col(f"n_{v}") / F.nullif(total, F.lit(0))).alias(f"pct_{v}") for v in values])


def average_rank(df: DataFrame, by: list[str], value: str, to: str) -> DataFrame:
    """Rank from 1; ties share their mean.

    Ties are counted by sums over (group, value) first, so a frequent value is one row; these rows are summed up along
    ranges of values, so a group of any size is many tasks'.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("__n"))
    below = windows.running_sum(counts, by, [value], "__n", "__upto")
    ranks = below.select(*by, value, (F.col("__upto") - F.col("__n") + (F.col("__n") + 1) / 2).alias(to))
    return _same([*by, value], df, ranks, "left")


def spearman(df: DataFrame, by: list[str], x: str, y: str, at_least: int = 5) -> DataFrame:
    """Rank correlation of pairs without a null; groups with fewer rows are left out."""
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    ranked = average_rank(average_rank(both, by, x, "__rx"), by, y, "__ry")
    return ranked.groupBy(*by).agg(F.count("*").alias("n"), F.corr("__rx", "__ry").alias("spearman")).filter(F.col("n") >= at_least)


def terciles(df: DataFrame, by: list[str], value: str, to: str = "tercile", at_least: int = 9) -> DataFrame:
    """low, mid, high by the group's thirds (right-closed); groups of fewer than ``at_least`` values are left out."""
    edges = df.filter(F.col(value).isNotNull()).groupBy(*by).agg(percentiles(value, ["1/3d", "2/3d"]).alias("e"), F.count("*").alias("__n")).filter(F.col("__n") >= at_least)
    d = df.filter(F.col(value).isNotNull()).join(edges.select(*[F.col(c).alias(f"__{c}") for c in by], "e"), [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]).drop(*[f"__{c}" for c in by])
    low, high = F.round(F.col("e")[0], 6), F.round(F.col("e")[1], 6)
    return d.withColumn(to, F.when(F.col(value) <= low, "low").when(F.col(value) <= high, "mid").otherwise("high")).drop("e")
