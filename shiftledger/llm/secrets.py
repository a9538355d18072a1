"""Secret scans: exact rules, and Markov models of random strings against ordinary identifiers.

Only built-in DataFrame functions. The rules find assigned passwords and tokens, access
key ids and long hex strings. What they find, over the whole corpus, is the labelled
sample of random strings; all other runs of at least ``SHORTEST`` identifier characters are the
sample of ordinary identifiers. A run that holds spans of the rules is cut there, and its other pieces count as runs. Counts of neighbouring characters in both give two
first-order Markov models, whose log-likelihood ratio is a table of one number per pair of
ASCII characters. Runs that score above zero leave the second sample, which may hold secrets
too, and the models are fitted once more. A run outside the rules' spans whose sum passes
``LEAST_RATIO`` is one more secret. Only the table of pair counts, bounded by the alphabet, reaches the driver.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftledger.llm.patterns import FOUND, matches
from shiftledger.session import new_folder

# The rules' patterns and least lengths.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "markov")
SHORTEST = 16
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % SHORTEST
LEAST_RATIO = 12.0  # natural logarithm
SMOOTHING = 0.5
CHARACTERS = 128
SPANS = "array<struct<start: int, rank: int, end: int>>"


def _spans(found: Column, kind: str) -> Column:
    return F.transform(
        found, lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), x["end"].alias("end"))
    )


def _outside(run: Column, base: Column) -> Column:
    """The pieces of a run, at least ``SHORTEST`` characters each, that lie outside the rules' spans."""
    touching = F.sort_array(F.filter(base, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"])))
    cuts = F.concat(
        F.transform(touching, lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"))),
        F.array(F.struct(run["end"].alias("start"), run["end"].alias("end"))),
    )
    start = F.struct(run["start"].alias("at"), F.array().cast(FOUND).alias("found"))

    def cut(held: Column, one: Column) -> Column:
        token = F.substring(run["token"], held["at"] - run["start"] + 1, F.greatest(one["start"] - held["at"], F.lit(0)))
        piece = F.struct(held["at"].alias("start"), one["start"].alias("end"), token.alias("token"), token.alias("part"))
        long = one["start"] - held["at"] >= SHORTEST
        return F.struct(
            F.greatest(held["at"], one["end"]).alias("at"),
            F.when(long, F.concat(held["found"], F.array(piece))).otherwise(held["found"]).alias("found"),
        )

    return F.aggregate(cuts, start, cut)["found"]


def scan(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(doc_id, base, secrets, runs): the rules' spans, their secret parts, and the runs outside of them."""
    rows = docs.select(docs[doc_id].alias("doc_id"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumns({
        "assign": F.filter(matches(F.col("text"), ASSIGN, 2), lambda x: F.length(x["part"]) >= ASSIGN_LEAST),
        "access": matches(F.col("text"), ACCESS),
        "hex": matches(F.col("text"), HEX),
        "every_run": matches(F.col("text"), RUN),
    }).drop("text")
    rows = rows.withColumn("base", F.concat(*[_spans(F.col(k), k) for k in KINDS[:3]]).cast(SPANS))
    outside = F.when(F.size("base") == 0, F.col("every_run")).otherwise(
        F.flatten(F.transform("every_run", lambda run: _outside(run, F.col("base"))))
    )
    secrets = F.concat(*[F.transform(F.col(k), lambda x: x["part"]) for k in KINDS[:3]])
    return rows.select("doc_id", "base", secrets.alias("secrets"), outside.alias("runs"))


def _pair(before: Column, now: Column) -> Column:
    return before * CHARACTERS + now


def ratio_table(scanned: DataFrame, smoothing: float = SMOOTHING) -> list[float]:
    """Log-likelihood ratio, random string against identifier, of each pair of characters (0 stands for the start).

    Without samples of both kinds all ratios are zero, and nothing is added to the rules.
    """
    samples = scanned.select(F.explode("secrets").alias("token"), F.lit(True).alias("random")).unionByName(
        scanned.select(F.explode(F.transform("runs", lambda x: x["token"])).alias("token"), F.lit(False).alias("random"))
    )
    characters = F.split("token", "")
    pairs = F.zip_with(characters, F.concat(F.array(F.lit("")), characters), lambda now, old: _pair(F.ascii(old), F.ascii(now)))
    counts = {True: {}, False: {}}
    for row in (
        samples.select("random", F.explode(pairs).alias("pair")).filter(f"pair % {CHARACTERS} > 0")
        .groupBy("random", "pair").count().collect()
    ):  # at most 2 * CHARACTERS ** 2 rows
        counts[row["random"]][row["pair"]] = row["count"]
    table = [0.0] * (CHARACTERS * CHARACTERS)
    if not counts[True] or not counts[False]:
        return table
    seen = sorted({pair % CHARACTERS for held in counts.values() for pair in held})
    for old in [0, *seen]:
        totals = {k: sum(held.get(old * CHARACTERS + now, 0) for now in seen) for k, held in counts.items()}
        for now in seen:
            pair = old * CHARACTERS + now
            chance = {
                k: (held.get(pair, 0) + smoothing) / (totals[k] + smoothing * len(seen)) for k, held in counts.items()
            }
            table[pair] = math.log(chance[True] / chance[False])
    return table


def log_ratio(token: Column, table: list[float]) -> Column:
    """Sum of the table over the neighbouring characters of a token."""
    held = F.from_json(F.lit(json.dumps([round(x, 6) for x in table])), "array<double>")
    start = F.struct(F.lit(0).alias("old"), F.lit(0.0).alias("sum"))

    def step(state: Column, character: Column) -> Column:
        now = F.ascii(character)
        return F.struct(now.alias("old"), (state["sum"] + F.get(held, _pair(state["old"], now))).alias("sum"))

    return F.aggregate(F.split(token, ""), start, step)["sum"]


def find_secrets(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", *, least_ratio: float = LEAST_RATIO
) -> DataFrame:
    """One row per document: doc_id, base and spans, arrays of (start, rank, end) in order.

    ``rank`` is the place of the kind in ``KINDS``; ``base`` has the rules' spans only. Places are
    code points, ends exclusive. Null text counts as empty and has no spans. Repeated rows and null ids are
    returned as they come; an empty table gives no rows; other columns are left out.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "secrets")
    scan(docs, text, doc_id).write.parquet(folder)
    scanned = spark.read.parquet(folder)
    first = ratio_table(scanned)
    ordinary = F.filter("runs", lambda run: log_ratio(run["token"], first) <= 0)
    table = ratio_table(scanned.select("secrets", ordinary.alias("runs")))
    added = F.filter("runs", lambda run: log_ratio(run["token"], table) >= least_ratio)
    return scanned.select(
        "doc_id", F.sort_array("base").alias("base"),
        F.sort_array(F.concat("base", _spans(added, "markov")).cast(SPANS)).alias("spans"),
    )


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["rank"]), x["start"].cast("string"), x["end"].cast("string"))),
        ",",
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts per kind, the digest of the rules' spans, and all spans as text."""
    count = lambda rank: F.size(F.filter("base", lambda x: x["rank"] == rank)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
    )
