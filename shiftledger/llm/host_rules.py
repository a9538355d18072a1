"""Quality rules per document, and verdicts per host from shrunk failure rates.

Only built-in DataFrame functions. Each text is read once; words repeated in
three-word windows are found inside the row: window hashes are compared as a set first, and only
texts that repeat one sort (hash, place) pairs. Failures are then summed per host, before any
shuffle, so a host with a third of all rows sends one row per task. The failure rate
of each rule is shrunk towards the rate of all hosts by a beta prior fitted to the hosts by
moments: (failures + a) / (documents + a + b). A host fails when a shrunk rate passes the
rule's limit, and its verdict is joined back to its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftledger.session import new_folder

WORD = r"[^\x20\x09-\x0D]+"
WHITE = r"[\x20\x09-\x0D]+"
FEWEST_WORDS = 50
LIMITS = {"few_words": 0.5, "repeats": 0.5, "symbols": 0.5, "lines": 0.5}  # shrunk share of failing documents
PRIOR_RANGE = (2.0, 1000.0)  # documents that the prior may weigh


def _named(frame: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns in a projection of its own, so that each is computed once."""
    return frame.withColumns(columns)


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines and n_repeat_words.

    These names, and ``_words`` and other names that begin with an underscore, replace columns of the input.
    """
    rows = _named(docs, _text=F.coalesce(docs[text].cast("string"), F.lit("")))
    rows = _named(
        rows,
        _words=F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)),
        _lines=F.filter(F.split("_text", "\n", -1), lambda line: line.rlike(WORD)),
        word_chars=F.length(F.regexp_replace("_text", WHITE, "")).cast("long"),
        n_symbols=F.length(F.regexp_replace("_text", r"[^#*$%&|<>]+", "")).cast("long"),
    )
    rows = _named(
        rows,
        n_words=F.size("_words").cast("long"),
        n_lines=F.size("_lines").cast("long"),
        n_dup_lines=(F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        _windows=F.transform(
            F.slice("_words", F.lit(1), F.greatest(F.size("_words") - 2, F.lit(0))),
            lambda word, i: F.xxhash64(word, F.get("_words", i + 1), F.get("_words", i + 2)),
        ),
    ).drop("_words", "_lines", "_text")
    rows = _named(
        rows,
        _sorted=F.when(
            F.size(F.array_distinct("_windows")) < F.size("_windows"),
            F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    ).drop("_windows")
    same = lambda i, j: F.get("_sorted", i)["h"] == F.get("_sorted", j)["h"]
    rows = _named(
        rows,
        _again=F.sort_array(F.array_compact(F.transform(
            "_sorted",
            lambda s, i: F.when(F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False)), s["i"]),
        ))),
    ).drop("_sorted")
    covered = F.transform("_again", lambda at, i: F.when(i == 0, 3).otherwise(F.least(F.lit(3), at - F.get("_again", i - 1))))
    return _named(
        rows, n_repeat_words=F.coalesce(F.aggregate(covered, F.lit(0), lambda a, b: a + b), F.lit(0)).cast("long")
    ).drop("_again")


def failures(rows: DataFrame) -> dict[str, Column]:
    """The rules: true where a measured document fails."""
    return {
        "few_words": F.col("n_words") < FEWEST_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > 50 * F.col("n_words"),
        "symbols": 10 * F.col("n_symbols") > 3 * F.col("n_words"),
        "lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
    }


def host_verdicts(measured: DataFrame, host: str = "host", limits: dict[str, float] | None = None) -> DataFrame:
    """One row per host: documents, shrunk rate of each rule, host_failed.

    The prior of a rule has the mean m of all documents and the weight
    m (1 - m) / v - 1, v being the variance of the hosts' rates weighted by documents; the
    weight is kept within ``PRIOR_RANGE``, whose upper end serves where the hosts do not differ.
    """
    limits = LIMITS if limits is None else limits
    rules = failures(measured)
    counts = measured.groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("n_docs"), *[F.sum(rules[name].cast("long")).alias(name) for name in limits]
    )
    everywhere = counts.agg(
        F.sum("n_docs").alias("all_docs"), *[F.sum(name).alias(f"all_{name}") for name in limits],
        *[F.sum(F.pow(name, F.lit(2.0)) / F.col("n_docs")).alias(f"squares_{name}") for name in limits],
    ).collect()  # one row
    total = everywhere[0]
    rated = counts
    failed = F.lit(False)
    for name, limit in limits.items():
        docs = total["all_docs"] or 1
        mean = (total[f"all_{name}"] or 0) / docs
        spread = (total[f"squares_{name}"] or 0.0) / docs - mean * mean
        low, high = PRIOR_RANGE
        weight = min(max(mean * (1 - mean) / spread - 1, low), high) if spread > 1e-12 else high
        rate = (F.col(name) + F.lit(mean * weight)) / (F.col("n_docs") + F.lit(weight))
        rated = rated.withColumn(f"{name}_rate", rate)
        failed = failed | (rate > limit)
    return rated.select("host", "n_docs", *[f"{name}_rate" for name in limits], failed.alias("host_failed"))


def judge(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", host: str = "source") -> DataFrame:
    """One row per document: doc_id, the measures, base_failed, host_failed, kept.

    ``host`` names a column or is an expression (of a URL, say) in column form. Null and empty texts
    have no words and fail the base rules; null hosts are one host. Repeated rows count and are returned
    each; null ids are kept; an empty table gives no rows.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "measures")
    source = docs[host] if isinstance(host, str) else host
    rows = docs.select(docs[doc_id].alias("doc_id"), source.cast("string").alias("host"), docs[text].alias("text"))
    measures(rows).drop("text").write.parquet(folder)
    measured = spark.read.parquet(folder)
    verdicts = host_verdicts(measured).select(F.col("host").alias("the_host"), "host_failed")
    rules = failures(measured)
    base = rules["few_words"] | rules["repeats"]
    return measured.join(verdicts, F.col("host").eqNullSafe(F.col("the_host")), "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"),
        "host_failed", (~base & ~F.col("host_failed")).alias("kept"),
    )
