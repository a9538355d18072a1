"""Run report: row counts per table, the latest check results, and their rendering."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

COUNTED = (
    "raw.employee_raw", "raw.timesheet_raw", "staging.employee_staging", "staging.timesheet_staging",
    "curated.employee", "curated.timesheet",
)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(label, rows) per table; employees also by active status and placeholder."""
    parts = []
    for place, table in enumerate(COUNTED):
        labels = {table: F.count(F.lit(1))}
        if table == "curated.employee":
            labels[f"{table} (active)"] = F.count_if("active_status")
            labels[f"{table} (placeholder)"] = F.count_if("is_placeholder")
        # The breakdown comes after all plain counts.
        entries = [
            F.struct(
                F.lit(place + len(COUNTED) * min(at, 1) + at).alias("place"),
                F.lit(label).alias("label"),
                count.alias("rows"),
            )
            for at, (label, count) in enumerate(labels.items())
        ]
        parts.append(tables[table].agg(F.array(*entries).alias("entries")))
    listed = reduce(DataFrame.unionByName, parts).select(F.explode("entries").alias("entry"))
    return listed.select("entry.*").orderBy("place").select("label", "rows")


RESULT_COLUMNS = ("check_name", "severity", "passed", "metric_value", "details")


def latest_results(results: DataFrame) -> DataFrame:
    """The check results of the most recent run."""
    last = results.agg(F.max_by("run_id", F.struct("run_at", "run_id")).alias("run_id"))
    return results.join(last, "run_id", "left_semi").select(*RESULT_COLUMNS).orderBy("check_name")


def passed_of_total(results: DataFrame) -> DataFrame:
    return results.agg(F.count_if("passed").alias("passed"), F.count(F.lit(1)).alias("total"))


def count_lines(counts: DataFrame) -> DataFrame:
    """(layer, table, rows) as shown: the label split at its first point, rows with separators."""
    return counts.select(
        F.substring_index("label", ".", 1).alias("layer"),
        F.regexp_replace("label", r"^[^.]*\.", "").alias("table"),
        F.format_number("rows", 0).alias("rows"),
    )


def check_lines(results: DataFrame) -> DataFrame:
    """Check results as shown: PASS or FAIL, and ``-`` for what is absent."""
    absent = F.lit("-")
    return results.select(
        "check_name",
        "severity",
        F.when(F.col("passed"), "PASS").otherwise("FAIL").alias("result"),
        F.coalesce(F.col("metric_value").cast("string"), absent).alias("value"),
        F.coalesce(F.nullif(F.col("details"), F.lit("")), absent).alias("details"),
    )


def _markdown_table(titles: list[str], rows: list[Row]) -> list[str]:
    body = ["| " + " | ".join(str(cell) for cell in row) + " |" for row in rows]
    return ["| " + " | ".join(titles) + " |", "|" + " --- |" * len(titles), *body, ""]


def write_report(
    spark: SparkSession, counts: DataFrame, results: DataFrame, folder: str, run_at: datetime
) -> dict[str, str]:
    """Writes the report of at most a few dozen lines as Markdown and JSON; returns the paths.

    The files are named by ``run_at`` and a random part, so no report replaces another.
    """
    results = results.select(*RESULT_COLUMNS)
    began = datetime.now()
    counted, checks = counts.collect(), results.collect()
    seconds = (datetime.now() - began).total_seconds()
    shown_counts = count_lines(spark.createDataFrame(counted, counts.schema)).collect()
    shown_checks = check_lines(spark.createDataFrame(checks, results.schema)).collect()
    passed = sum(row["passed"] for row in checks)

    stamp = run_at.strftime("%Y-%m-%d %H:%M:%S")
    markdown = [
        f"# Workforce tables on {stamp}", "",
        f"{passed} of {len(checks)} checks hold. Counting took {seconds:.2f} seconds.", "",
        "## Rows per table", "", *_markdown_table(["layer", "table", "rows"], shown_counts),
        "## Checks", "", *_markdown_table(["check", "severity", "outcome", "value", "findings"], shown_checks),
    ]
    document = json.dumps({
        "timestamp": stamp,
        "duration_seconds": seconds,
        "row_counts": {row["label"]: row["rows"] for row in counted},
        "quality_checks": [row.asDict() for row in checks],
    })
    written, name = {}, f"report_{run_at:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"
    for kind, lines in {"md": markdown, "json": [document]}.items():
        path = f"{folder.rstrip('/')}/{name}.{kind}"
        text = "\n".join(lines)
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
        written[kind] = path
    return written
