"""The full run: files to raw, staging and curated tables, then checks and report."""

from __future__ import annotations

import logging
import time
import uuid
import zlib
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftledger.operators import ConstraintViolation, insert_absent, missing_keys, upsert
from shiftledger.operators.constraints import BROKEN, ROW_RULES, mark_broken, orphan_keys
from shiftledger.plans import daily, edits, quality, report
from shiftledger.plans.clean import clean_employees, clean_timesheets, junk_summary, placeholders, unreadable_texts
from shiftledger.plans.curate import PUNCH_KEY, absent_timesheets, curate_employees, curate_timesheets
from shiftledger.plans.formats import column_formats
from shiftledger.rules import Rules
from shiftledger.schemas import EMPLOYEE_FIELDS, TIMESHEET_FIELDS
from shiftledger.session import new_folder
from shiftledger.sources import Intake, Layers, read_delimited

log = logging.getLogger(__name__)

ID = "client_employee_id"
KNOWN_EMPLOYEE = "client_employee_id_known"

# Beside the positions of a commit of staged timesheets: the raw position they begin after, and what they were staged by.
STAGED_AFTER, STAGED_BY = "staged_after", "staged_by"


class Refresh(NamedTuple):
    """What a run left behind; the frames are lazy."""

    layers: Layers
    rejected_files: DataFrame
    junk_ids: DataFrame
    results: DataFrame
    report_paths: dict[str, str]
    date_formats: DataFrame  # per file and date column of what was staged: the way round of its dates, and whether it is a guess
    unreadable: DataFrame  # per table and column: texts staged and values read from them


def load_raw(
    layers: Layers, table: str, folder: str, columns: list[str], rules: Rules, *, mode: str, recursive: bool
) -> Intake:
    """Appends the files of a folder to a raw table.

    ``append`` takes all files at every run; ``new_files`` only those that no
    committed load holds, by path, length and time of change.
    """
    if mode not in ("append", "new_files"):
        raise ValueError(f"unknown mode: {mode}")
    loaded = layers.loaded_files(table) if mode == "new_files" else None
    intake = read_delimited(layers.spark, folder, columns, rules, recursive=recursive, loaded=loaded)
    for row in intake.rejects.collect():
        log.error("%s: file refused, %s", row["source_file"], row["reason"])
    if intake.files_read:
        counts = layers.append(intake.rows, table, files=intake.files)
        log.info("%s: %s rows from %s files", table, counts["rows"], intake.files_read)
    else:
        log.warning("%s: no files to load in %s", table, folder)
    return intake


def _raw_rows(layers: Layers, raw: str, consumer: str, only_this_load: bool) -> tuple[DataFrame, dict[str, int]]:
    """All raw rows, or those of the loads that ``consumer`` has not taken up; and how far it has when they are in.

    Loads that a stopped run left behind are among them. Only the folders of these loads are read.
    """
    upto = layers.position(raw)
    after = layers.consumed(consumer, raw) if only_this_load else 0
    return layers.read(raw, after=after, upto=upto), {raw: upto}


def merge(
    layers: Layers, incoming: DataFrame, table: str, rules: Rules, on_violation: str, consumed: dict[str, int] | None = None
) -> None:
    """Upserts employees. In quarantine only good rows are merged, so a bad update leaves the stored row as it is.

    Only the folders in which incoming keys lie are read and written.
    """
    folder = new_folder(layers.spark, "incoming")
    quarantine = on_violation == "quarantine"
    (mark_broken(incoming, ROW_RULES[table]) if quarantine else incoming).write.parquet(folder)
    incoming = layers.spark.read.parquet(folder)
    if quarantine:
        layers.set_aside(incoming.where(F.size(BROKEN) > 0), table)
        incoming = incoming.where(F.size(BROKEN) == 0).drop(BROKEN)
    parts = layers.parts_of(incoming, table)
    if parts:
        merged = upsert(layers.read(table, parts=parts), incoming, ID, rules.stamp)
        layers.replace(merged, table, consumed=consumed, parts=parts)
    elif consumed:
        layers.advance(table, consumed)


def stage_employees(
    layers: Layers, rules: Rules, *, on_violation: str = "fail", only_this_load: bool = False
) -> bool:
    """Returns whether there was anything to stage."""
    table = "staging.employee_staging"
    raw, consumed = _raw_rows(layers, "raw.employee_raw", table, only_this_load)
    if raw.isEmpty():
        log.warning("no raw employees, nothing to stage")
        return False
    merge(layers, clean_employees(raw, rules), table, rules, on_violation, consumed)
    return True


def _fingerprint(rules: Rules, on_violation: str) -> int:
    """A number for all that staging depends on beside its rows; the time of the run is no part of it."""
    return zlib.crc32(repr((replace(rules, run_at=None), on_violation)).encode())


def stage_timesheets(
    layers: Layers, rules: Rules, *, on_violation: str = "fail", only_this_load: bool = False
) -> bool:
    """Reloads the staged timesheets and adds a placeholder for every unknown employee id.

    With ``only_this_load`` the staged rows are those of all loads that the curated table lacks. If a run that stopped later
    has staged just these by the same rules, they are not read again. Returns whether there was anything to stage.
    """
    raw, consumed = _raw_rows(layers, "raw.timesheet_raw", "curated.timesheet", only_this_load)
    if raw.isEmpty():
        log.warning("no raw timesheets, nothing to stage")
        return False
    now = F.lit(rules.stamp).cast("timestamp")
    table, people = "staging.timesheet_staging", "staging.employee_staging"
    if only_this_load:
        consumed |= {
            STAGED_AFTER: layers.consumed("curated.timesheet", "raw.timesheet_raw"), STAGED_BY: _fingerprint(rules, on_violation),
        }
    if not only_this_load or layers.last_consumed(table) != consumed:
        staged = clean_timesheets(raw, rules).withColumn("created_at", now)
        layers.replace(staged, table, on_violation=on_violation, consumed=consumed)
    unknown = placeholders(layers.read(table), layers.read(people))
    layers.append(unknown.withColumns({"created_at": now, "updated_at": now}), people)
    return True


def load_employees(layers: Layers, rules: Rules, *, on_violation: str = "fail", only_this_load: bool = False) -> None:
    """Upserts the staged employees into the curated table.

    With ``only_this_load`` only the folders in which staged employees have changed are taken up, unless the table was last loaded
    as of another day: days of tenure grow for all employees, so the first load of a day takes all.
    """
    table, source = "curated.employee", "staging.employee_staging"
    day = rules.as_of.toordinal()
    consumed = {source: layers.position(source), edits.AS_OF: day}
    parts = None
    if only_this_load and layers.consumed(table, edits.AS_OF) == day:
        parts = layers.changed_parts(source, layers.consumed(table, source))
    staged = layers.read(source, upto=consumed[source], parts=parts)
    if staged.isEmpty():
        log.warning("no staged employees, nothing to curate")
        return
    edits.apply_stored(layers, rules)
    loaded = edits.with_edits(layers, curate_employees(staged, rules), rules)
    merge(layers, loaded, table, rules, on_violation, consumed)


def _held_near(held: DataFrame, incoming: DataFrame, *, null_safe: bool) -> DataFrame:
    """The rows of ``held`` that can share a key with ``incoming``: those in its span of punch times.

    A known punch time equals only itself, so the scan of the history is pruned by the load's first
    and last; missing times are kept where they count as equal.
    """
    punch = F.col("punch_in_datetime")
    first, last = incoming.agg(F.min(punch), F.max(punch)).first()
    inside = punch.between(F.lit(first), F.lit(last)) if first is not None else F.lit(False)
    return held.where(inside | punch.isNull() if null_safe else inside)


def _with_known_employees(layers: Layers, rows: DataFrame, staged: DataFrame, table: str, on_violation: str) -> DataFrame:
    """The punches whose employee is curated; others stop the load or go to quarantine.

    ``rows`` come from ``staged``, so they are worked out for this only if an id that is staged is unknown.
    """
    people = layers.read("curated.employee")
    if missing_keys(staged, people, ID).isEmpty():
        return rows
    orphans = orphan_keys(rows, people, ID)
    if on_violation != "quarantine":
        count = orphans.agg(F.sum("rows")).first()[0]
        if count:
            raise ConstraintViolation(table, {KNOWN_EMPLOYEE: count})
        return rows
    ids = orphans.select(ID)
    layers.set_aside(rows.join(ids, ID, "left_semi").withColumn(BROKEN, F.array(F.lit(KNOWN_EMPLOYEE))), table)
    return rows.join(ids, ID, "left_anti")


def load_timesheets(
    layers: Layers, rules: Rules, *, on_violation: str = "fail", null_safe: bool = True
) -> None:
    """Adds the punches that the curated table lacks; those it has stay as they are.

    Missing punch times are equal by default, so that a repeated load adds nothing. With
    ``null_safe=False`` they differ from everything, as in a SQL unique constraint.
    """
    table, source, raw = "curated.timesheet", "staging.timesheet_staging", "raw.timesheet_raw"
    upto = layers.consumed(source, raw)
    consumed = {raw: upto} if upto else None
    staged = layers.read(source)
    if staged.isEmpty():
        log.warning("no staged timesheets, nothing to curate")
        if consumed:
            layers.advance(table, consumed)
        return
    held = _held_near(layers.read(table), staged, null_safe=null_safe)
    if null_safe:
        fresh = absent_timesheets(staged, held, rules)
    else:
        fresh = insert_absent(held, curate_timesheets(staged, rules), PUNCH_KEY, unique=True)
    fresh = _with_known_employees(layers, fresh, staged, table, on_violation)
    now = F.lit(rules.stamp).cast("timestamp")
    layers.append(fresh.withColumn("created_at", now), table, on_violation=on_violation, consumed=consumed)


def check(layers: Layers, rules: Rules, *, json_path: str | None = None) -> DataFrame:
    """Stores the check results, then stops the run when a critical check failed."""
    results = quality.run_checks(
        layers.read("curated.employee"), layers.read("curated.timesheet"), rules,
        f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}",  # later runs have larger ids
    )
    layers.append(results, "quality.check_results")
    if json_path:
        quality.write_json(results, json_path)
    quality.gate(results)
    return results


def refresh(
    spark: SparkSession,
    root: str,
    employee_folder: str,
    timesheet_folder: str,
    rules: Rules,
    *,
    mode: str = "append",
    recursive: bool = True,
    on_violation: str = "fail",
    null_safe: bool = True,
    only_this_load: bool = False,
) -> Refresh:
    """Runs all steps in order. ``root`` is a folder that all executors share.

    By default all raw rows are staged again at every run. With
    ``only_this_load`` only those that no run has curated yet are, and tables without new files are not
    curated again: employees are updated by the latest load and punches already
    there stay, and the work follows the load instead of the whole history. Without ``rules.run_at`` the
    clock is read once, at the start, so that later runs of a day are later.

    A run may stop at any point. Each step commits its rows together with how far it has consumed its source, so the
    next run goes on from there, also with ``mode="new_files"``, which does not load the files again. A load that breaks
    a rule stays pending until a run sets its bad rows aside (``on_violation="quarantine"``). A file that was replaced is
    loaded again in full and its earlier rows stay in raw: employees are updated by it, punches are added, none is taken back.
    """
    if rules.run_at is None:
        rules = replace(rules, run_at=datetime.now())
    layers = Layers(spark, root)
    options = {"mode": mode, "recursive": recursive}
    people = load_raw(layers, "raw.employee_raw", employee_folder, list(EMPLOYEE_FIELDS), rules, **options)
    punches = load_raw(layers, "raw.timesheet_raw", timesheet_folder, list(TIMESHEET_FIELDS), rules, **options)
    scope = {"on_violation": on_violation, "only_this_load": only_this_load}
    rows = {
        "raw.employee_raw": _raw_rows(layers, "raw.employee_raw", "staging.employee_staging", only_this_load)[0],
        "raw.timesheet_raw": _raw_rows(layers, "raw.timesheet_raw", "curated.timesheet", only_this_load)[0],
    }
    stage_employees(layers, rules, **scope)
    new_punches = stage_timesheets(layers, rules, **scope)  # may bring placeholders
    edits.apply_stored(layers, rules)
    staged = "staging.employee_staging"
    if layers.position(staged) > layers.consumed("curated.employee", staged):
        load_employees(layers, rules, **scope)
    if new_punches:
        load_timesheets(layers, rules, on_violation=on_violation, null_safe=null_safe)
    daily.update(layers)  # also what a stopped run left
    reports = f"{layers.root}/reports"
    results = check(layers, rules, json_path=f"{reports}/quality_{uuid.uuid4().hex}.json")
    paths = report.write_report(
        spark,
        report.row_counts({table: layers.read(table) for table in report.COUNTED}),
        report.latest_results(layers.read("quality.check_results")),
        reports,
        rules.stamp,
    )
    return Refresh(
        layers,
        people.rejects.unionByName(punches.rejects),
        junk_summary(layers.read("raw.timesheet_raw"), rules),
        results,
        paths,
        _by_table(rows, column_formats),
        _by_table(rows, lambda raw, fields: unreadable_texts(raw, fields, rules)),
    )


def _by_table(rows: dict[str, DataFrame], told: Callable[[DataFrame, dict], DataFrame]) -> DataFrame:
    fields = {"raw.employee_raw": EMPLOYEE_FIELDS, "raw.timesheet_raw": TIMESHEET_FIELDS}
    frames = [told(raw, fields[table]).withColumn("table", F.lit(table)) for table, raw in rows.items()]
    return frames[0].unionByName(frames[1])
