"""Quality rules with host verdicts: DataFrame functions only.

Each document gets counts and a base verdict. Failures are summed by host, each host's failure rate is shrunk towards
an empirical beta prior (method of moments over all hosts, weighted by documents), and a host whose shrunk rate
exceeds ``HOST_RATE`` is rejected; its documents go too, whatever they look like themselves. One small host with a bad
page is thus not judged on that page alone, and a large one is judged by its own record.

Cases: null or empty text has no words and fails; a null host is one host of its own; no documents: no rows; repeated
rows count each; a null id stays. Nothing is sampled; a hot host is summed in part by each task first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import join_small, let, written

#: A host goes when its shrunk failure rate is above this.
HOST_RATE = 0.75
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
_BLANKS = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Runs of anything but ASCII white space."""
    return F.filter(F.split(F.translate(text, _BLANKS, " " * 6), " "), lambda w: w != "")


def repeat_words(w: Column) -> Column:
    """Words that lie in a window of three words found twice or more.

    The windows' hashes are sorted with their places, so equal windows stand side by side; each repeated window covers
    the words from its place on that the next repeated one doesn't.
    """
    n = F.size(w)

    def count(keyed: Column) -> Column:
        again = F.filter(
            F.transform(keyed, lambda x, k: F.when(F.coalesce(F.get(keyed, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(keyed, k + 1)["h"] == x["h"], F.lit(False)), x["at"])),
            lambda p: p.isNotNull(),
        )
        return let(F.sort_array(again), lambda p: F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x))

    windows = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("at")))
    return F.when(n < 4, F.lit(0)).otherwise(let(F.sort_array(windows), count))


def document_rules(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) and base_failed."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, _BLANKS, "")) > 0)
    stats = let(
        words(text),
        lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeat_words(w).cast("long").alias("n_repeat_words")),
    )
    d = docs.withColumn("__s", stats)
    return d.select(
        *docs.columns,
        F.col("__s.n_words").alias("n_words"),
        F.length(F.translate(text, _BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.col("__s.n_repeat_words").alias("n_repeat_words"),
    ).withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def host_verdicts(judged: DataFrame, host_col: str = "source", failed_col: str = "base_failed", limit: float = HOST_RATE) -> DataFrame:
    """(host, n_docs, n_failed, rate, host_rejected): one row for each host.

    The prior's mean and variance are those of the hosts' rates, each host weighted by its documents; alpha and beta
    follow by moments, with at least one document's weight and at most a thousand's. Only the three sums reach the driver.
    """
    hosts = judged.groupBy(F.col(host_col).alias("host")).agg(F.count("*").alias("n_docs"), F.sum(F.col(failed_col).cast("long")).alias("n_failed"))
    r = F.col("n_failed") / F.col("n_docs")
    docs, fails, squares = hosts.agg(F.sum("n_docs"), F.sum("n_failed"), F.sum(F.round(F.col("n_docs") * r * r * 1e6).cast("long"))).first()
    mean = (fails or 0) / docs if docs else 0.0
    variance = max(0.0, (squares or 0) / 1e6 / docs - mean * mean) if docs else 0.0
    strength = min(1000.0, max(1.0, mean * (1 - mean) / variance - 1)) if variance > 0 else 1000.0
    rate = (F.col("n_failed") + F.lit(strength * mean)) / (F.col("n_docs") + F.lit(strength))
    return hosts.withColumn("rate", rate).withColumn("host_rejected", F.col("rate") > limit)


def quality(docs: DataFrame, host_col: str = "source", text_col: str = "text", id_col: str = "doc_id", limit: float = HOST_RATE) -> DataFrame:
    """One row a document: id, the counts, base_failed, the host's shrunk rate and verdict, kept."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), F.col(text_col).alias("text"))
    judged = written(document_rules(d).drop("text"), "quality")
    hosts = host_verdicts(judged, "host", limit=limit).select("host", F.round("rate", 9).alias("host_rate"), "host_rejected")
    out = join_small(judged, hosts, "host")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "host_rate", "host_rejected", (~F.col("base_failed") & ~F.col("host_rejected")).alias("kept"))


def good_documents(docs: DataFrame, host_col: str = "source", text_col: str = "text", limit: float = HOST_RATE) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns.

    Documents are judged once: good ones are written beside each document's host and verdict, of which the hosts' sums
    read only these two columns. No text is shuffled; of the hosts, only rejected ones are joined.
    """
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(host_col).alias("host"), F.col(text_col).alias("text"))
    judged = written(document_rules(own).select(F.when(~F.col("base_failed"), F.col("row")).alias("row"), "host", "base_failed"), "judged")
    bad = written(host_verdicts(judged, "host", limit=limit).filter("host_rejected").select("host", F.lit(True).alias("bad")), "hosts")
    return join_small(judged.filter("not base_failed"), bad, "host").filter("bad is null").select("row.*")
