"""Secret scans: DataFrame functions only.

Base rules find assignments, access keys and long hex runs. The method adds runs of 20 or more token characters that a
battery of randomness tests takes for random rather than language-like:

* the encoding is inferred from the characters (hex, base32, lower-case letters, lower-case with digits, base64);
* chi-squared of the symbols against a uniform alphabet. Under the null hypothesis of this search (language-like text)
  it is noncentral with ``n * delta`` for that alphabet, so a value far below its mean is evidence of a random string;
  that tail is the candidate's p value. Longer candidates can reach smaller p values: length is in the null itself;
* runs above and below the alphabet's middle and lag-one serial correlation, both two-sided: a candidate that fails
  either, or chi-squared upwards, isn't random at all (keyboard rows, counters, repeated blocks) and gets p = 1;
* Benjamini-Hochberg at rate ``RATE`` within each length band (powers of two) over all candidates of the table. Ranks
  come from a histogram of p values in tenths of a decade, so nothing is sorted; its size is bounded by bands and bins.

Places are running sums of the lengths of matches and of what lies between them. Running sums and maxima are made in
rounds over growing stretches, so a text with n matches costs n log n, not n squared.

Cases: null and empty text have no span; several kinds may overlap, but an added span never overlaps a base one; an
empty table gives no row; repeated rows and null ids give a row each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import let, running, written

#: Fixed by the task: what the base rules look for.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
LEAST_VALUE = 6
#: Runs that the tests look at.
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
RATE, VETO, BINS = 0.01, 0.001, 400
#: Encodings in the order of their inference: pattern, alphabet, and chi-squared's noncentrality per symbol for language-like text.
ENCODINGS = (
    (r"^[0-9a-f]+$", "0123456789abcdef", 0.6),
    (r"^[0-9A-F]+$", "0123456789ABCDEF", 0.6),
    (r"^[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 1.1),
    (r"^[a-z]+$", "abcdefghijklmnopqrstuvwxyz", 0.73),
    (r"^[a-z0-9]+$", "abcdefghijklmnopqrstuvwxyz0123456789", 1.4),
    (r"", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 3.2),
)
SPAN = "array<struct<start:bigint,k:int,end:bigint>>"
FOUND = "array<struct<start:bigint,k:int,end:bigint,m:string>>"


def matches(text: Column, pattern: str, k: int, value: int = 0, least: int = 0, with_text: bool = False, measure: Callable[[Column], Column] = F.length) -> Column:
    """Leftmost non-overlapping matches as spans in code points (or what ``measure`` counts); the texts between matches give the places.

    ``least``: characters that group ``value`` must have; a match that fails is dropped after matching.
    """
    found, parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value)) if value else found

    def long(x: Column) -> Column:
        return measure(x).cast("long")

    def placed(x: Column) -> Column:
        ends = running(F.transform(x["f"], lambda m, i: long(F.get(x["p"], i)) + long(m)), lambda a, b: a + b)
        return let(ends, lambda e: F.transform(x["f"], lambda m, i: F.struct((F.get(e, i) - long(m)).alias("start"), F.lit(k).alias("k"), F.get(e, i).alias("end"), m.alias("m"), F.get(x["v"], i).alias("v"))))

    spans = let(F.struct(found.alias("f"), parts.alias("p"), values.alias("v")), placed)
    if least:
        spans = F.filter(spans, lambda s: F.length(s["v"]) >= least)
    out = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["k"].alias("k"), s["end"].alias("end"), *([s["m"].alias("m")] if with_text else [])))
    return F.when(text.rlike(pattern), out).otherwise(F.array().cast(FOUND if with_text else SPAN))


def apart(found: Column, base: Column) -> Column:
    """Those of ``found`` (disjoint spans) that no span of ``base`` overlaps, by one merge in the order of starts."""
    far = F.lit(1 << 62)
    events = F.sort_array(F.concat(F.transform(base, lambda b: F.struct(b["start"].alias("start"), b["k"].alias("k"), b["end"].alias("end"), F.lit(None).cast("string").alias("m"))), found))

    def judged(e: Column) -> Column:
        reach = running(F.transform(e, lambda x: F.when(x["k"] < 3, x["end"]).otherwise(F.lit(0).cast("long"))), F.greatest)
        ahead = F.reverse(running(F.reverse(F.transform(e, lambda x: F.when(x["k"] < 3, x["start"]).otherwise(far))), F.least))
        return let(F.struct(reach.alias("reach"), ahead.alias("ahead")), lambda q: F.filter(e, lambda x, i: (x["k"] == 3) & (F.get(q["reach"], i) <= x["start"]) & (F.get(q["ahead"], i) >= x["end"])))

    return F.when((F.size(found) == 0) | (F.size(base) == 0), found).otherwise(let(events, judged))


def tail(x: Column) -> Column:
    """P(Z > x) of the normal distribution, within half a percent, also far out."""
    a = F.abs(x)
    upper = F.exp(-a * a / 2) / (1.64 * a + F.sqrt(0.76 * a * a + 4))
    return F.when(x >= 0, upper).otherwise(1 - upper)


def p_value(m: Column) -> Column:
    """Small for strings that look random, 1 where a test says they can't be; from the string alone."""
    which = F.lit(len(ENCODINGS) - 1)
    for i in range(len(ENCODINGS) - 2, -1, -1):
        which = F.when(m.rlike(ENCODINGS[i][0]), F.lit(i)).otherwise(which)
    table = F.array(*[F.struct(F.lit(a).alias("alphabet"), F.lit(float(len(a))).alias("k"), F.lit(d).alias("delta")) for _, a, d in ENCODINGS])

    def of(e: Column) -> Column:
        plain = F.translate(F.regexp_replace(m, "=+$", ""), "-_", "+/")
        idx = F.filter(F.transform(F.split(plain, ""), lambda c: F.instr(e["alphabet"], c).cast("double") - 1), lambda v: v >= 0)
        return let(F.struct(idx.alias("v"), e["k"].alias("k"), e["delta"].alias("delta")), tested)

    def tested(s: Column) -> Column:
        v, k, delta = s["v"], s["k"], s["delta"]
        n = F.size(v).cast("double")
        zero = F.lit(0.0)
        squares = let(F.sort_array(v), lambda o: F.aggregate(o, F.struct(F.lit(-1.0).alias("x"), zero.alias("c"), zero.alias("s")), lambda a, x: F.struct(x.alias("x"), F.when(a["x"] == x, a["c"] + 1).otherwise(1.0).alias("c"), (a["s"] + F.when(a["x"] == x, 2 * a["c"] + 1).otherwise(1.0)).alias("s")))["s"])
        chi = squares * k / n - n
        high = F.aggregate(v, zero, lambda a, x: a + F.when(x >= k / 2, 1.0).otherwise(0.0))
        turns = F.aggregate(F.sequence(F.lit(1), F.size(v) - 1), F.lit(1.0), lambda a, i: a + F.when((F.get(v, i) >= k / 2) != (F.get(v, i - 1) >= k / 2), 1.0).otherwise(0.0))
        mean = F.aggregate(v, zero, lambda a, x: a + x) / n
        return let(
            F.struct(chi.alias("chi"), high.alias("hi"), turns.alias("turns"), mean.alias("mean")),
            lambda q: let(
                F.struct(
                    F.aggregate(v, zero, lambda a, x: a + (x - q["mean"]) * (x - q["mean"])).alias("var"),
                    F.aggregate(F.sequence(F.lit(1), F.size(v) - 1), zero, lambda a, i: a + (F.get(v, i) - q["mean"]) * (F.get(v, i - 1) - q["mean"])).alias("cov"),
                ),
                lambda c: combined(q, c, n, k, delta),
            ),
        )

    def combined(q: Column, c: Column, n: Column, k: Column, delta: Column) -> Column:
        two = 2 * q["hi"] * (n - q["hi"])
        runs = (q["turns"] - two / n - 1) / F.sqrt(F.greatest(two * (two - n) / (n * n * (n - 1)), F.lit(1e-9)))
        serial = c["cov"] / F.greatest(c["var"], F.lit(1e-9)) * F.sqrt(n)
        high = (q["chi"] - (k - 1)) / F.sqrt(2 * (k - 1))
        low = (q["chi"] - (k - 1) - n * delta) / F.sqrt(2 * (k - 1) + 4 * n * delta)
        veto = F.least(2 * tail(F.abs(runs)), 2 * tail(F.abs(serial)), tail(high)) < VETO / 3
        return F.when(veto | (c["var"] <= 0), 1.0).otherwise(F.least(F.lit(1.0), tail(-low)))

    return F.coalesce(let(F.get(table, which), of), F.lit(1.0))


def bin_of(p: Column) -> Column:
    return F.least(F.lit(BINS), F.floor(-10 * F.log10(F.greatest(p, F.lit(1e-300))))).cast("int")


def band_of(n: Column) -> Column:
    return F.floor(F.log2(n.cast("double"))).cast("int")


def scanned(docs: DataFrame, text_col: str = "text", measure: Callable[[Column], Column] = F.length) -> DataFrame:
    """``docs`` with ``__base`` (spans) and ``__more`` (candidates: start, end, band, bin); places as ``measure`` counts."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = F.concat(matches(text, ASSIGN, 0, 2, LEAST_VALUE, measure=measure), matches(text, ACCESS, 1, measure=measure), matches(text, HEX, 2, measure=measure))
    d = docs.withColumn("__base", F.sort_array(base)).withColumn("__all", matches(text, TOKEN, 3, with_text=True, measure=measure))
    d = d.withColumn("__all", apart(F.col("__all"), F.col("__base")))
    more = F.transform("__all", lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), band_of(c["end"] - c["start"]).alias("band"), bin_of(p_value(c["m"])).alias("bin")))
    return d.withColumn("__more", F.when(F.size("__all") > 0, more).otherwise(F.array().cast("array<struct<start:bigint,end:bigint,band:int,bin:int>>"))).drop("__all")


def bands(found: DataFrame, rate: float = RATE) -> dict[int, int]:
    """Per length band the least bin that Benjamini-Hochberg accepts; at most about 30 bands."""
    h = found.select(F.explode("__more").alias("c")).groupBy("c.band", "c.bin").agg(F.count("*").alias("n"))
    w = Window.partitionBy("band")
    ranked = h.withColumn("total", F.sum("n").over(w)).withColumn("rank", F.sum("n").over(w.orderBy(F.desc("bin"))))
    ok = ranked.filter(F.col("total") * F.pow(F.lit(10.0), -F.col("bin") / 10) <= rate * F.col("rank")).groupBy("band").agg(F.min("bin").alias("bin"))
    return {r["band"]: r["bin"] for r in ok.collect()}


def accepted(limits: dict[int, int]) -> Column:
    """All spans of a row of ``scanned``."""
    none = F.array().cast(SPAN)
    if not limits:
        return F.col("__base")
    least = F.create_map(*[x for k, v in limits.items() for x in (F.lit(k), F.lit(v))])
    added = F.transform(F.filter("__more", lambda c: c["bin"] >= least[c["band"]]), lambda c: F.struct(c["start"].alias("start"), F.lit(3).alias("k"), c["end"].alias("end")))
    return F.sort_array(F.concat("__base", F.coalesce(added, none)))


def joined(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["k"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans)."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = written(scanned(d).drop("text"), "scanned")
    every = found.withColumn("__spans", accepted(bands(found, rate)))

    def n(k: int) -> Column:
        return F.size(F.filter("__spans", lambda s: s["k"] == k)).cast("long")

    return every.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"), n(3).alias("n_random"), F.sha2(joined(F.col("__base")), 256).alias("base_sha256"), joined(F.col("__spans")).alias("spans"))


def redacted(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", rate: float = RATE) -> DataFrame:
    """``docs`` with every span replaced by ``mark``; overlapping spans become one mark. The columns stay.

    Rows are scanned once and written with their spans; the limits of the whole table then decide about the candidates.
    """
    columns = docs.columns
    own = scanned(docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{text_col}`").alias("text")), measure=F.octet_length)
    own = written(own.drop("text"), "scanned")
    text, spans = F.col(f"row.`{text_col}`"), accepted(bands(own, rate))

    def kept(x: Column) -> Column:
        """The bytes between spans: from where the spans so far end to where the next begins."""
        before = F.transform(x["s"], lambda s, i: F.struct(F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(x["e"], i - 1)).alias("a"), s["start"].alias("b")))
        gaps = F.concat(F.filter(before, lambda g: g["b"] >= g["a"]), F.array(F.struct(F.element_at(x["e"], -1).alias("a"), F.octet_length(x["t"]).cast("long").alias("b"))))
        return F.array_join(F.transform(gaps, lambda g: F.substring(x["t"], (g["a"] + 1).cast("int"), (g["b"] - g["a"]).cast("int")).cast("string")), mark)

    whole = let(spans, lambda s: let(F.struct(s.alias("s"), running(F.transform(s, lambda x: x["end"]), F.greatest).alias("e"), text.cast("binary").alias("t")), kept))
    clean = F.when(text.isNull() | (F.size(spans) == 0), text).otherwise(whole)
    return own.select(*[clean.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in columns])
