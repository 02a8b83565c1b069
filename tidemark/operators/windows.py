"""Window operators: pairs of neighbours, running extremes, momentum, ranks, sequence gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.sinks import staged


def over(by: list[str], order: list[str | Column]):
    return Window.partitionBy(*by).orderBy(*order)


def change(df: DataFrame, by: list[str], order: list[str], value: str, to: str) -> DataFrame:
    """Difference to the row before."""
    return df.withColumn(to, F.col(value) - F.lag(value).over(over(by, order)))


def pairs(df: DataFrame, by: list[str], order: list[str | Column], columns: list[str]) -> DataFrame:
    """Each row with its predecessor's ``columns`` as ``pre_*``; a key's first row has none and goes."""
    w = over(by, order)
    out = df.select("*", F.lag(F.lit(True)).over(w).alias("__has"), *[F.lag(c).over(w).alias(f"pre_{c}") for c in columns])
    return out.filter("__has").drop("__has")


def running_max(df: DataFrame, by: list[str], order: list[str], value: str, to: str = "max_so_far") -> DataFrame:
    return df.withColumn(to, F.max(value).over(over(by, order).rowsBetween(Window.unboundedPreceding, 0)))


def momentum(df: DataFrame, by: list[str], time_us: str, values: list[str]) -> DataFrame:
    """Changes since the row before, minutes since it, and minutes since the key's (first) maximum, null before that."""
    w = over(by, [time_us])
    first = Window.partitionBy(*by)
    at_max = F.max_by(time_us, F.when(F.col(values[0]).isNotNull(), F.struct(F.col(values[0]), -F.col(time_us)))).over(first)
    since = (F.col(time_us) - at_max) / 6e7
    return df.select("*", *[(F.col(v) - F.lag(v).over(w)).alias(f"{v}_change") for v in values], ((F.col(time_us) - F.lag(time_us).over(w)) / 6e7).alias("minutes_since_previous"), F.when(since >= 0, since).alias("minutes_since_max"))


def first_maximum(df: DataFrame, by: list[str], time_us: str, value: str) -> DataFrame:
    """(maximum, when it was first reached, how many values there are) of each key; a two-step sum, no window."""
    best = F.max_by(F.struct(value, time_us), F.when(F.col(value).isNotNull(), F.struct(F.col(value), -F.col(time_us))))
    return df.groupBy(*by).agg(best.alias("b"), F.count(value).alias("n")).select(*by, F.col(f"b.{value}").alias("max_value"), F.col(f"b.{time_us}").alias("max_us"), "n")


def label_quality(n: Column, enough: int = 12) -> Column:
    """How much a day's observed maximum is worth."""
    return F.when(n == 0, "NO_DATA").when(n < enough, "SPARSE").otherwise("OK")


def latest(df: DataFrame, by: list[str], order: list[str], n: int = 1) -> DataFrame:
    """The last ``n`` rows of each key with their place (1: the last). For one row per key use ``max_by`` sums instead."""
    w = Window.partitionBy(*by).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= n)


def unsorted_rows(df: DataFrame, by: list[str], arrival: str, time: str) -> DataFrame:
    """Rows that arrived after a later one of their key."""
    return df.withColumn("before", F.max(time).over(over(by, [arrival]).rowsBetween(Window.unboundedPreceding, -1))).filter(F.col(time) < F.col("before"))


def prefix(df: DataFrame, by: list[str], order: str, values: dict[str, tuple[Column, str]], width: int, inclusive: bool = True) -> DataFrame:
    """Running maxima and sums along a whole-number ``order``, cut into stretches of ``width``.

    ``values``: new column -> (value, "max" or "sum"); nulls don't count, a sum of nothing is 0. A stretch is a small window
    of its own, and what it inherits is one row per key and stretch: a key that holds much of the data isn't one task's.
    Without ``inclusive`` the row itself doesn't count.
    """
    kinds = {"max": (F.max, F.greatest), "sum": (F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))}
    d = df.withColumns({f"__v_{c}": v for c, (v, _) in values.items()} | {"__b": F.floor(F.col(order) / width)})
    w = over([*by, "__b"], [order]).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    inside = d.withColumns({f"__in_{c}": kinds[k][0](f"__v_{c}").over(w) for c, (_, k) in values.items()})
    ends = d.groupBy(*by, "__b").agg(*[kinds[k][0](f"__v_{c}").alias(f"__end_{c}") for c, (_, k) in values.items()])
    past = over(by, ["__b"]).rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(*[F.col(c).alias(f"__{c}") for c in by], F.col("__b").alias("__cb"), *[kinds[k][0](f"__end_{c}").over(past).alias(f"__carry_{c}") for c, (_, k) in values.items()])
    on = [F.col("__b") == F.col("__cb"), *[F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]]
    out = inside.join(carry, on, "left").withColumns({c: kinds[k][1](F.col(f"__in_{c}"), F.col(f"__carry_{c}")) for c, (_, k) in values.items()})
    return out.drop("__b", "__cb", *[f"__{c}" for c in by], *[f"__{x}_{c}" for c in values for x in ("v", "in", "carry")])


def prefix_max(df: DataFrame, by: list[str], order: str, value: Column, to: str, width: int, inclusive: bool = True) -> DataFrame:
    return prefix(df, by, order, {to: (value, "max")}, width, inclusive)


def prefix_sum(df: DataFrame, by: list[str], order: str, value: Column, to: str, width: int) -> DataFrame:
    return prefix(df, by, order, {to: (value, "sum")}, width)


def sequence_flags(df: DataFrame, stream: str, order: str, seq: str, width: int = 1 << 20) -> DataFrame:
    """FIRST, DUPLICATE_OR_OLD, GAP or OK: against the highest number before. Old numbers don't move it."""
    flag = F.when(F.col("__top").isNull(), "FIRST").when(F.col(seq) <= F.col("__top"), "DUPLICATE_OR_OLD").when(F.col(seq) > F.col("__top") + 1, "GAP").otherwise("OK")
    return prefix_max(df, [stream], order, F.col(seq), "__top", width, inclusive=False).withColumn("flag", flag).drop("__top")


def running_sum(df: DataFrame, by: list[str], order: list[str], value: str, to: str) -> DataFrame:
    """The sum of ``value`` over a key's rows up to each one; ``order`` orders them fully.

    Rows are dealt by ranges of (key, order), so a key of any size lies in many ranges; each is a window of its own, and
    inherits the sums of the key's ranges before it, one row each. Rows with equal order may be parted, not changed.
    """
    d = staged(df.repartitionByRange(*by, *order).withColumn("__range", F.spark_partition_id()))
    inside = d.withColumn("__in", F.sum(value).over(over([*by, "__range"], order).rowsBetween(Window.unboundedPreceding, 0)))
    ends = d.groupBy(*by, "__range").agg(F.sum(value).alias("__end"))
    past = F.coalesce(F.sum("__end").over(over(by, ["__range"]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    carry = ends.select(*[F.col(c).alias(f"__{c}") for c in by], F.col("__range").alias("__r"), past.alias("__carry"))
    on = [F.col("__range") == F.col("__r"), *[F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]]
    out = inside.join(carry, on).withColumn(to, F.col("__in") + F.col("__carry"))
    return out.drop("__range", "__r", "__in", "__carry", *[f"__{c}" for c in by])


def ranked(df: DataFrame, by: list[str], order: list[str], rank: str = "rank", n: str = "n") -> DataFrame:
    """Each row's rank in its key, from 0, and the key's number of rows; no task holds a whole key."""
    counted = running_sum(df.withColumn("__one", F.lit(1).cast("long")), by, order, "__one", "__upto").withColumn(rank, (F.col("__upto") - 1).cast("int")).drop("__one", "__upto")
    sizes = df.groupBy(*by).agg(F.count("*").alias(n)).withColumnsRenamed({c: f"__{c}" for c in by})
    return counted.join(sizes, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]).drop(*[f"__{c}" for c in by])


def rank_sample(df: DataFrame, by: list[str], order: list[str], k: int) -> DataFrame:
    """``k`` rows of each key at even ranks (first and last included): a systematic sample, the same each time.

    Ranks are rounded half to even; ranks that coincide give one row.
    """
    steps = F.array(F.lit(0)) if k == 1 else F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.bround(i * (F.col("n") - 1) / F.lit(k - 1)).cast("int"))
    return ranked(df, by, order).filter(F.array_contains(steps, F.col("rank"))).drop("n")


def share(df: DataFrame, by: list[str], value: str, to: str = "share") -> DataFrame:
    return df.withColumn(to, F.col(value) / F.sum(value).over(Window.partitionBy(*by)))


def close_together(df: DataFrame, by: list[str], time_us: str, minutes: float) -> DataFrame:
    """Rows less than ``minutes`` after the one before."""
    d = df.withColumn("minutes_since_previous", (F.col(time_us) - F.lag(time_us).over(over(by, [time_us]))) / 6e7)
    return d.filter(F.col("minutes_since_previous") < minutes)
