"""Text products: sections of bulletins, climate reports, forecasters, links, sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How the products are laid out.
SECTION = r"(?m)^\.([A-Z][A-Z0-9 /]+?)\.\.\.[ \t\r]*$"
REPORT_DATE = r"(?i)THE CENTRAL PARK NY CLIMATE SUMMARY FOR\s+([A-Z]+ \d{1,2} \d{4})\.\.\."
PRELIMINARY = r"(?i)VALID TODAY AS OF\s+\d{3,4}\s*(?:AM|PM)\s+LOCAL TIME"
MAXIMUM = r"(?i)TEMPERATURE \(F\)\s*\n\s*(?:YESTERDAY|TODAY)\s*\n\s*MAXIMUM\s+(-?\d+|MM)([A-Z]?)\s+(\d{1,4}\s*(?:AM|PM)|MM)"
MINIMUM = r"(?i)MINIMUM\s+(-?\d+|MM)([A-Z]?)\s+(\d{1,4}\s*(?:AM|PM)|MM)"
LEAST_F, MOST_F = -40, 120
_OPEN, _CLOSE = "\u0001", "\u0002"


def sections(df: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """(keys, position, section_name, section_text): the text before the first heading is ``HEADER``, if there is any."""
    marked = F.split(F.regexp_replace(F.col(text), SECTION, f"{_OPEN}$1{_CLOSE}"), _OPEN)
    rows = df.filter(F.col(text).isNotNull()).select(*keys, (F.size(marked) == 1).alias("__one"), F.posexplode(marked).alias("position", "piece"))
    head = F.col("position") == 0
    name = F.when(head, "HEADER").otherwise(F.trim(F.split_part("piece", F.lit(_CLOSE), F.lit(1))))
    body = F.when(head, F.col("piece")).otherwise(F.btrim(F.split_part("piece", F.lit(_CLOSE), F.lit(2)), F.lit(" \n\r\t")))
    return rows.filter(~head | (F.col("piece") != "") | F.col("__one")).select(*keys, "position", name.alias("section_name"), body.alias("section_text"))


def is_relevant(section_name: Column) -> Column:
    """The sections that a state quotes."""
    return section_name.startswith("SYNOPSIS") | section_name.startswith("NEAR TERM") | section_name.startswith("SHORT TERM")


def forecaster(text: Column) -> Column:
    """The last of the closing five lines that is two to four capitals; null if none is."""
    lines = F.split(F.btrim(text, F.lit(" \n\r\t")), r"\r?\n")
    tail = F.transform(F.reverse(F.slice(lines, F.greatest(F.size(lines) - 4, F.lit(1)), F.lit(5))), F.trim)
    return F.get(F.filter(tail, lambda x: x.rlike("^[A-Z]{2,4}$")), F.lit(0))


def climate_report(df: DataFrame, text: str, product_id: str) -> DataFrame:
    """Parsed climate reports: an unreadable one has ``parse_error`` and no values; MM is a missing value, not zero."""
    t = F.col(text)
    get = lambda pattern, i, of=t: F.nullif(F.regexp_extract(of, pattern, i), F.lit(""))
    d = df.select(
        "*", get(REPORT_DATE, 1).alias("__date"), t.rlike(PRELIMINARY).alias("is_preliminary"), F.upper(get(MAXIMUM, 1)).alias("__max"), get(MAXIMUM, 2).alias("__max_flag"), get(MAXIMUM, 3).alias("__max_time"),
        F.substr(t, F.regexp_instr(t, F.lit(MAXIMUM)) + F.length(F.regexp_extract(t, MAXIMUM, 0))).alias("__rest"),
    )
    d = d.select("*", F.upper(get(MINIMUM, 1, F.col("__rest"))).alias("__min"), get(MINIMUM, 2, F.col("__rest")).alias("__min_flag"), get(MINIMUM, 3, F.col("__rest")).alias("__min_time"))
    words = F.split("__date", " ")
    day = F.try_to_date(F.concat_ws(" ", F.initcap(words[0]), words[1], words[2]), "MMMM d yyyy")
    high = F.col("__max").try_cast("double")
    error = F.when(F.col("__date").isNull(), "no header date").when(day.isNull(), "unknown date").when(F.col("__max").isNull(), "no maximum").when(~high.between(LEAST_F, MOST_F), "implausible maximum")
    ok = error.isNull()
    there = lambda value, c: F.when(ok & (F.col(value) != "MM"), F.trim(c))
    return d.select(
        *df.columns, F.try_to_timestamp(F.split(F.col(product_id), "-")[0], F.lit("yyyyMMddHHmm")).alias("issuance_time"), F.when(ok, day).alias("target_date"), "is_preliminary",
        F.when(ok, high).alias("max_temp_f"), there("__max", F.col("__max_time")).alias("max_temp_time_lst"), F.when(ok, F.col("__max_flag")).alias("max_temp_flag"),
        F.when(ok, F.col("__min").try_cast("double")).alias("min_temp_f"), F.when(ok, F.trim("__min_time")).alias("min_temp_time_lst"), F.when(ok, F.col("__min_flag")).alias("min_temp_flag"), error.alias("parse_error"),
    )


def approximate_tokens(text: Column) -> Column:
    """A quarter of the characters, rounded down."""
    return F.floor(F.length(text) / 4)


def links(html: Column) -> Column:
    """Distinct link targets, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(html, F.lit(r'href="([^"]+)"'), F.lit(1))))


def product_ids(html: Column, pil: str) -> Column:
    """Distinct product ids of one kind in a listing page, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(html, F.lit(rf"(\d{{12}}-[A-Z]{{4}}-[A-Z0-9]{{6}}-{pil}(?:-[A-Z]{{3}})?)"), F.lit(1))))


def safe_name(name: Column) -> Column:
    return F.regexp_replace(name, r"[^A-Za-z0-9._-]", "_")
