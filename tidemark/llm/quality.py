"""Host-level quality rules, in DataFrame operations only.

Each document is tested by rules of its own. Failures are counted by host, each host's
failure rate is shrunk with a beta prior fitted to all hosts, and hosts whose shrunken rate
is too high have all their documents rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import staged

SEPARATORS = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
REPEAT_WORDS = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
#: A host goes if its shrunken failure rate is above this.
MAX_HOST_RATE = 0.5


def _word_metrics(docs: DataFrame, window: int) -> DataFrame:
    """doc_id, host, text, n_words, n_repeat_words. Windows are compared by 64-bit hash within a text."""
    rows = docs.withColumn("pieces", F.split("text", SEPARATORS, -1))
    # Only the first and last piece can be empty: before or after white space at the ends.
    begin = F.when(F.get("pieces", F.lit(0)) == "", 1).otherwise(0)
    end = F.size("pieces") - F.when((F.size("pieces") > begin) & (F.element_at("pieces", -1) == ""), 1).otherwise(0)
    rows = rows.withColumn("words", F.transform(F.slice("pieces", begin + 1, F.greatest(end - begin, F.lit(0))),
                                                lambda w: F.xxhash64(w))).drop("pieces")
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    rows = rows.withColumn("grams", F.when(F.size("words") >= window, F.transform(
        F.slice("words", 1, F.size("words") - (window - 1)),
        lambda w, i: F.xxhash64(w, *[F.get("words", i + k) for k in range(1, window)]))).otherwise(
            F.array().cast("array<bigint>"))).drop("words")
    # Sorted hashes side by side tell which occur again; texts without any need no more.
    rows = rows.withColumn("sorted", F.sort_array("grams"))
    rows = rows.withColumn("again", F.array_distinct(F.filter(
        "sorted", lambda g, i: g == F.get("sorted", i + 1)))).drop("sorted")
    # Starts of windows that occur again, found by sorting (hash, start) pairs of such texts.
    rows = rows.withColumn("pairs", F.when(F.size("again") > 0, F.sort_array(F.transform(
        "grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))))).drop("grams", "again")
    rows = rows.withColumn("starts", F.sort_array(F.transform(F.filter("pairs", lambda p, k: F.coalesce(
        (p["g"] == F.get("pairs", k - 1)["g"]), F.lit(False)) | F.coalesce(
            (p["g"] == F.get("pairs", k + 1)["g"]), F.lit(False))), lambda p: p["i"]))).drop("pairs")
    covered = F.aggregate(F.transform("starts", lambda s, k: F.least(
        F.lit(window), F.coalesce(F.get("starts", k + 1) - s, F.lit(window)))), F.lit(0).cast("long"),
        lambda n, x: n + x)
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0))).drop("starts")


def _without(characters: str) -> Column:
    return F.length(F.translate("text", characters, ""))


def document_metrics(docs: DataFrame, host: str = "source", window: int = REPEAT_WORDS) -> DataFrame:
    """doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed.

    A null text is an empty one: no words, and so base_failed.
    """
    rows = docs.select("doc_id", F.col(host).alias("host"), F.coalesce("text", F.lit("")).alias("text"))
    rows = _word_metrics(rows, window)
    rows = rows.withColumn("lines", F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    rows = rows.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    failed = ((F.col("n_words") < MIN_WORDS)
              | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PERCENT))
    return rows.select("doc_id", "host", "n_words", _without(" \t\n\x0b\x0c\r").cast("long").alias("word_chars"),
                       (F.length("text") - _without(SYMBOLS)).cast("long").alias("n_symbols"), "n_dup_lines",
                       "n_repeat_words", failed.alias("base_failed"))


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """Mean and strength (documents it is worth) of the prior, from host, n_docs and n_failed.

    Moments of the hosts' rates weighted by their documents, less the variance that counting
    alone gives. Where hosts do not differ beyond that, the prior is as strong as all documents.
    """
    n, rate = F.col("n_docs").cast("double"), F.col("n_failed") / F.col("n_docs")
    total, first, second, k = hosts.agg(F.sum(n), F.sum(n * rate), F.sum(n * rate * rate), F.count("*")).first()
    if not k:
        return 0.0, 0.0
    mean = first / total
    within = mean * (1 - mean)
    between = max(second / total - mean * mean, 0.0) - within * k / total
    return mean, min(max(within / between - 1, 0.0), total) if between > 0 else total


def host_verdicts(hosts: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """host, n_docs, n_failed, host_rate (shrunken) and host_kept, one row per host (null is one)."""
    mean, strength = beta_prior(hosts)
    shrunk = (F.col("n_failed") + F.lit(mean * strength)) / F.nullif(F.col("n_docs") + F.lit(strength), F.lit(0.0))
    return hosts.withColumn("host_rate", shrunk).withColumn("host_kept", F.col("host_rate") <= max_rate)


def judge_documents(docs: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Per document its metrics, base_failed, and kept: it passes its own rules and its host's.

    Other columns: host_rate, the host's shrunken failure rate. A null host is a host of its
    own; repeated rows and null ids count like any other; an empty table gives no rows.
    """
    metrics = staged(document_metrics(docs, host), "metrics")
    # Stored on both sides, the join is one that Spark sends out whole if the hosts are few (it
    # knows the size) and splits at the hosts of very many documents if not.
    counts = metrics.groupBy("host").agg(F.count("*").alias("n_docs"), F.count_if("base_failed").alias("n_failed"))
    hosts = host_verdicts(staged(counts, "hosts"), max_rate).withColumnRenamed("host", "of")
    return metrics.join(hosts, F.col("host").eqNullSafe(F.col("of")), "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.col("host_kept")).alias("kept"), "host_rate")
