"""As-of joins: for each left row the right row that was last (or next, or nearest) in time.

Both sides are united and read in time order by a window, so the work is linear in rows however many right rows precede
a left one. Keys are split by time buckets: a key that holds much of the data is many small windows, and what a bucket
inherits from earlier ones is one row per key and bucket. Ties: right rows of one instant are ordered by ``tie``; the
largest wins backward, the smallest forward.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOUR = 3_600_000_000
#: Width of a time bucket: a month.
BUCKET = 30 * 24 * HOUR


def us(t: Column) -> Column:
    """Microseconds since the epoch of a timestamp with or without zone (UTC)."""
    return F.unix_micros(t.cast("timestamp"))


def _directed(left: DataFrame, right: DataFrame, by: list[str], time: str, right_time: str, tie: list[str], backward: bool, inclusive: bool, bucket: int, to: str) -> DataFrame:
    sign = 1 if backward else -1
    keys = [F.col(c).alias(f"__k{i}") for i, c in enumerate(by)]
    names = [f"__k{i}" for i in range(len(by))]
    r = right.filter(F.col(right_time).isNotNull()).select(*keys, (_time(right, right_time) * sign).alias("__t"), F.struct(*[F.col(f"`{c}`") for c in tie]).alias("__tie") if tie else F.lit(None).cast("struct<x:int>").alias("__tie"), F.struct(*[F.col(f"`{c}`") for c in right.columns]).alias("__r"))
    l = left.select(*keys, (_time(left, time) * sign).alias("__t"), F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("__l"))  # noqa: E741
    every = l.withColumn("__side", F.lit(1 if inclusive else -1)).unionByName(r.withColumn("__side", F.lit(0)), allowMissingColumns=True).withColumn("__b", F.floor(F.col("__t") / bucket))
    tie_order = F.col("__tie").asc() if backward else F.col("__tie").desc()
    w = Window.partitionBy(*names, "__b").orderBy(F.col("__t"), F.col("__side"), tie_order).rowsBetween(Window.unboundedPreceding, 0)
    inside = every.withColumn(to, F.last("__r", ignorenulls=True).over(w)).filter("__l is not null")
    # the last right row of each bucket, carried into the buckets after it
    order = F.struct(F.col("__t"), F.col("__tie")) if backward else F.struct(F.col("__t"))
    ends = every.groupBy(*names, "__b").agg(F.max_by(F.col("__r"), F.when(F.col("__r").isNotNull(), order)).alias("__end"))
    carry = ends.withColumn("__carry", F.last("__end", ignorenulls=True).over(Window.partitionBy(*names).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1))).drop("__end")
    both = inside.join(carry.select(*[F.col(n).alias(f"{n}_") for n in names], F.col("__b").alias("__b_"), "__carry"), [F.col("__b") == F.col("__b_"), *[F.col(n).eqNullSafe(F.col(f"{n}_")) for n in names]], "left")
    return both.select("__l.*", F.coalesce(to, "__carry").alias(to))


def asof_join(left: DataFrame, right: DataFrame, by: list[str], time: str, right_time: str, direction: str = "backward", tie: list[str] | None = None, inclusive: bool = True, tolerance_us: int | None = None, bucket_us: int = BUCKET, to: str = "match") -> DataFrame:
    """``left`` with the struct ``to``: the matching row of ``right``, or null.

    ``direction``: backward (at or before), forward (at or after), nearest (ties go backward). ``inclusive=False``
    leaves out right rows of the same instant. Beyond ``tolerance_us`` there is no match. Null times never match.
    """
    tie = tie or []
    if direction == "nearest":
        b = _directed(left, right, by, time, right_time, tie, True, inclusive, bucket_us, "__back")
        both = _directed(b, right, by, time, right_time, tie, False, False, bucket_us, "__next")
        gap = lambda c: F.abs(_time(both, time) - _time_of(c, right_time, right))
        later = F.col("__next").isNotNull() & (F.col("__back").isNull() | (gap("__next") < gap("__back")))
        out = both.withColumn(to, F.when(later, F.col("__next")).otherwise(F.col("__back"))).drop("__back", "__next")
    else:
        out = _directed(left, right, by, time, right_time, tie, direction == "backward", inclusive, bucket_us, to)
    if tolerance_us is not None:
        near = F.abs(_time(out, time) - _time_of(to, right_time, right)) <= tolerance_us
        out = out.withColumn(to, F.when(near, F.col(to)))
    return out


def _time(df: DataFrame, c: str) -> Column:
    return F.col(c).cast("long") if dict(df.dtypes)[c] in ("bigint", "int") else us(F.col(c))


def _time_of(struct: str, c: str, right: DataFrame) -> Column:
    return F.col(f"{struct}.{c}").cast("long") if dict(right.dtypes)[c] in ("bigint", "int") else us(F.col(f"{struct}.{c}"))


def with_predecessor(df: DataFrame, by: list[str], time: str, tie: list[str], bucket: int = BUCKET, to: str = "__before") -> DataFrame:
    """Each row with the struct of the row before it in its key, by ``time`` and ``tie``; null times come first.

    Keys are cut by time buckets: only a bucket's first row looks at the last row of the bucket before, one row each.
    """
    own, names = F.struct(*[F.col(f"`{c}`") for c in df.columns]), [f"__k{i}" for i in range(len(by))]
    order = F.struct(F.col("__t").isNotNull().alias("known"), "__t", *[F.col(f"`{c}`") for c in tie])
    d = df.select("*", own.alias("__own"), _time(df, time).alias("__t"), *[F.col(f"`{c}`").alias(n) for c, n in zip(by, names, strict=True)]).withColumn("__b", F.floor(F.col("__t") / bucket)).withColumn("__o", order)
    inside = d.withColumn("__in", F.lag("__own").over(Window.partitionBy(*names, "__b").orderBy("__o")))
    ends = d.groupBy(*names, "__b").agg(F.max_by("__own", "__o").alias("__end"))
    carry = ends.select(*[F.col(n).alias(f"{n}_") for n in names], F.col("__b").alias("__b_"), F.lag("__end").over(Window.partitionBy(*names).orderBy(F.col("__b").asc_nulls_first())).alias("__carry"))
    both = inside.join(carry, [F.col("__b").eqNullSafe(F.col("__b_")), *[F.col(n).eqNullSafe(F.col(f"{n}_")) for n in names]], "left")
    return both.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce("__in", "__carry").alias(to))


def last_two(left: DataFrame, right: DataFrame, by: list[str], time: str, right_time: str, tie: list[str] | None = None, to: tuple[str, str] = ("latest", "previous"), bucket_us: int = BUCKET) -> DataFrame:
    """The latest and the one before it: each right row first carries its own predecessor, so one as-of join serves both."""
    paired = with_predecessor(right, by, right_time, tie or [], bucket_us)
    out = asof_join(left, paired, by, time, right_time, tie=tie, to="__m", bucket_us=bucket_us)
    fields = [F.col(f"__m.`{c}`").alias(c) for c in right.columns]
    return out.select(*left.columns, F.when(F.col("__m").isNotNull(), F.struct(*fields)).alias(to[0]), F.col("__m.__before").alias(to[1]))


def fresh(match: Column, age_us: Column, limit_us: int = 6 * HOUR) -> Column:
    """``match`` while its age is at most ``limit_us`` (the limit itself is fresh), else null; ages stay visible elsewhere."""
    return F.when(age_us <= limit_us, match)
