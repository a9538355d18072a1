from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from shiftledger.operators import ConstraintViolation
from shiftledger.plans import quality
from shiftledger.plans.refresh import load_raw, refresh
from shiftledger.rules import Rules
from shiftledger.schemas import EMPLOYEE_FIELDS
from shiftledger.session import new_folder, shared_folder
from shiftledger.sources import Layers, list_files, read_delimited
from shiftledger.sources.delimited import _inspect

RULES = Rules(as_of=date(2024, 5, 1), run_at=datetime(2024, 5, 1, 8))
COLUMNS = ["client_employee_id", "first_name", "last_name", "department_name"]


def put(folder, name, text, encoding="utf-8"):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode(encoding))


def rows(df, *names):
    return sorted((tuple(row) for row in df.select(*names).collect()), key=str)


def intake(spark, folder, **options):
    return read_delimited(spark, str(folder), COLUMNS, RULES, **options)


def test_read_two_rows(spark, tmp_path):
    put(tmp_path, "a.csv", "client_employee_id|first_name|last_name|department_name\nE001|Alice|Smith|Engineering\nE002|Bob|Jones|[NULL]\n")
    found = intake(spark, tmp_path)
    assert found.rows.columns[:4] == COLUMNS
    assert rows(found.rows, *COLUMNS, "source_file", "loaded_at") == [
        ("E001", "Alice", "Smith", "Engineering", "a.csv", RULES.stamp),
        ("E002", "Bob", "Jones", None, "a.csv", RULES.stamp),
    ]


def test_quoting(spark, tmp_path):
    put(tmp_path, "q.csv", 'client_employee_id|first_name|last_name\n1|"a|b"|"say ""hi"""\n2|"two\nlines"|\\n\n3|5\'10" tall|x"y\n\n4|""|"NULL"\n')
    assert rows(intake(spark, tmp_path).rows, "client_employee_id", "first_name", "last_name") == [
        ("1", "a|b", 'say "hi"'), ("2", "two\nlines", "\\n"), ("3", "5'10\" tall", 'x"y'), ("4", None, None),
    ]


def test_quotes_inside_values_leave_a_file_splittable(spark, tmp_path):
    put(tmp_path, "q.csv", 'client_employee_id|first_name\n1|5\'10" tall\n2|b\n')
    found = intake(spark, tmp_path)
    assert rows(found.rows, "client_employee_id", "first_name") == [("1", "5'10\" tall"), ("2", "b")]
    assert [file.multi_line for file in _inspect(spark, [str(tmp_path / "q.csv")], RULES)] == [False]
    put(tmp_path, "q.csv", 'client_employee_id|first_name\n1|"a\nb"\n')
    assert [file.multi_line for file in _inspect(spark, [str(tmp_path / "q.csv")], RULES)] == [True]


def test_layouts_are_matched_by_name(spark, tmp_path):
    put(tmp_path, "a.csv", "client_employee_id|first_name\n1|a\n")
    put(tmp_path, "b c+d%.csv", "last_name|bonus|client_employee_id\nz|9|2\ny\n")
    found = intake(spark, tmp_path)
    assert rows(found.rows, *COLUMNS, "source_file") == [
        ("1", "a", None, None, "a.csv"), ("2", None, "z", None, "b c+d%.csv"), (None, None, "y", None, "b c+d%.csv"),
    ]
    assert rows(found.unknown_columns, "source_file", "column_name") == [("b c+d%.csv", "bonus")]
    assert found.files_read == 2


def test_bad_files_are_refused_whole(spark, tmp_path):
    put(tmp_path, "good.csv", "client_employee_id|first_name\n1|a\n")
    put(tmp_path, "long.csv", "client_employee_id|first_name\n2|b\n3|c|d\n")
    put(tmp_path, "long_quoted.csv", 'client_employee_id|first_name\n4|"e\nf"\n5|g|"h\n|i"\n')
    put(tmp_path, "bytes.csv", b"client_employee_id|first_name\n6|\xff\xfe\n")
    put(tmp_path, "twice.csv", "client_employee_id|first_name|first_name\n7|a|b\n")
    put(tmp_path, "other.csv", "x|y\n8|a\n")
    put(tmp_path, "empty.csv", "")
    put(tmp_path, "header_only.csv", "client_employee_id|first_name\n")
    found = intake(spark, tmp_path)
    assert rows(found.rows, "client_employee_id") == [("1",)]
    assert [name for name, in rows(found.rejects, "source_file")] == [
        "bytes.csv", "empty.csv", "long.csv", "long_quoted.csv", "other.csv", "twice.csv",
    ]


def test_folders(spark, tmp_path):
    put(tmp_path, "a.csv", "client_employee_id\n1\n")
    put(tmp_path, "notes.txt", "client_employee_id\n2\n")
    put(tmp_path, "deep/er/b.csv", "client_employee_id\n3\n")
    assert rows(intake(spark, tmp_path).rows, "client_employee_id") == [("1",)]
    assert rows(intake(spark, tmp_path, recursive=True).rows, "client_employee_id") == [("1",), ("3",)]
    assert rows(list_files(spark, str(tmp_path), recursive=True), "source_file") == [("a.csv",), ("b.csv",)]


@pytest.mark.parametrize("folder", ["nothing_here", "."])
def test_no_files(spark, tmp_path, folder):
    found = intake(spark, tmp_path / folder)
    assert found.rows.count() == 0 and found.files_read == 0
    assert found.rows.columns == [*COLUMNS, "source_file", "source_path", "loaded_at", "source_offset", "source_row"]


def test_row_position_follows_the_file_across_splits(spark, tmp_path):
    lines = "".join(f"{n:06d}|name {n}\n" for n in range(5000))
    put(tmp_path, "big.csv", "client_employee_id|first_name\n" + lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = intake(spark, tmp_path).rows.select("client_employee_id", "source_offset", "source_row").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len({row["source_offset"] for row in found}) > 1
    ordered = sorted(found, key=lambda row: (row["source_offset"], row["source_row"]))
    assert [int(row["client_employee_id"]) for row in ordered] == list(range(5000))


def test_only_new_files(spark, tmp_path):
    layers = Layers(spark, new_folder(spark, "layers"))
    load = dict(columns=list(EMPLOYEE_FIELDS), rules=RULES, recursive=False)
    put(tmp_path, "a.csv", "client_employee_id\n1\n")
    load_raw(layers, "raw.employee_raw", str(tmp_path), mode="new_files", **load)
    put(tmp_path, "b.csv", "client_employee_id\n2\n")
    load_raw(layers, "raw.employee_raw", str(tmp_path), mode="new_files", **load)
    load_raw(layers, "raw.employee_raw", str(tmp_path), mode="new_files", **load)
    assert rows(layers.read("raw.employee_raw"), "client_employee_id") == [("1",), ("2",)]
    load_raw(layers, "raw.employee_raw", str(tmp_path), mode="append", **load)
    assert layers.read("raw.employee_raw").count() == 4


def test_long_quoted_fields(spark, tmp_path):
    long, doubled = "x" * 5_000, '""' * 100_000
    put(tmp_path, "q.csv", f'client_employee_id|first_name|last_name\n1|"{long}"|a\n2|"{"y|" * 500_000}"|"{doubled}"\n3|""""|b\n')
    found = intake(spark, tmp_path)
    assert rows(found.rows, "client_employee_id", "first_name", "last_name") == [
        ("1", long, "a"), ("2", "y|" * 500_000, '"' * 100_000), ("3", '"', "b"),
    ]
    put(tmp_path, "r.csv", f'client_employee_id|first_name\n1|"{long}"|"{doubled}"\n')
    assert rows(intake(spark, tmp_path).rejects, "source_file") == [("r.csv",)]


def test_wide_files_do_not_stop_the_others(spark, tmp_path):
    put(tmp_path, "good.csv", "client_employee_id\n1\n")
    header = "client_employee_id" + "".join(f"|c{n}" for n in range(10_000))
    put(tmp_path, "wide.csv", f"{header}\n2{'|' * 10_010}\n")
    put(tmp_path, "wide_breaks.csv", f'{header}\n3|"a\nb"{"|" * 30_000}\n')
    put(tmp_path, "wide_good.csv", f"{header}\n4{'|' * 10_000}\n")
    found = intake(spark, tmp_path)
    assert rows(found.rows, "client_employee_id") == [("1",), ("4",)]
    assert rows(found.rejects, "source_file") == [("wide.csv",), ("wide_breaks.csv",)]


def test_new_files_are_told_by_path_and_change(spark, tmp_path):
    layers = Layers(spark, new_folder(spark, "layers"))
    load = dict(columns=list(EMPLOYEE_FIELDS), rules=RULES, recursive=True, mode="new_files")
    for month, text in (("2024/01", "1"), ("2024/02", "22"), ("2024/01", "333")):  # the last replaces the first
        put(tmp_path, f"{month}/punches.csv", f"client_employee_id\n{text}\n")
        before = layers.position("raw.employee_raw")
        load_raw(layers, "raw.employee_raw", str(tmp_path), **load)
        assert rows(layers.read("raw.employee_raw", after=before), "client_employee_id") == [(text,)]
    assert rows(layers.read("raw.employee_raw"), "client_employee_id") == [("1",), ("22",), ("333",)]
    paths = {row["source_path"] for row in layers.read("raw.employee_raw").collect()}
    assert len(paths) == 2 and all(path.endswith("punches.csv") for path in paths)


# --- layer tables and the full run -----------------------------------------------------


def staged(spark, *hours):
    return spark.createDataFrame(
        [(f"E{n}", value, "f.csv") for n, value in enumerate(hours)],
        "client_employee_id string, hours_worked int, source_file string",
    )


def test_failed_load_changes_nothing(spark):
    layers = Layers(spark, new_folder(spark, "layers"))
    table = "staging.timesheet_staging"
    layers.replace(staged(spark, 1, 2), table)
    with pytest.raises(ConstraintViolation) as error:
        layers.replace(staged(spark, 5, -1), table)
    assert error.value.counts == {"hours_worked_not_negative": 1}
    assert layers.read(table).count() == 2


def test_quarantine_keeps_good_rows(spark):
    layers = Layers(spark, new_folder(spark, "layers"))
    table = "staging.timesheet_staging"
    assert layers.quarantined(table) is None
    layers.replace(staged(spark, 1, -2, 3), table, on_violation="quarantine")
    assert rows(layers.read(table), "client_employee_id") == [("E0",), ("E2",)]
    assert rows(layers.quarantined(table), "client_employee_id", "broken_rules") == [("E1", ["hours_worked_not_negative"])]
    layers.replace(staged(spark, 1, -2), table, on_violation="quarantine")  # the same bad row again
    assert layers.read(table).count() == 1 and layers.quarantined(table).count() == 1
    layers.replace(staged(spark, -1), table, on_violation="quarantine")
    assert layers.read(table).count() == 0 and layers.quarantined(table).count() == 2


def test_append_reads_its_own_table(spark):
    layers = Layers(spark, new_folder(spark, "layers"))
    table = "staging.timesheet_staging"
    layers.append(staged(spark, 1), table)
    layers.append(layers.read(table), table)
    assert layers.read(table).count() == 2
    layers.replace(layers.read(table).limit(1), table)
    assert layers.read(table).count() == 1


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


EMPLOYEES = """client_employee_id|first_name|last_name|department_id|department_name|hire_date|term_date
E1|Ann|Lee|1|A-Ward|2020-01-05|[NULL]
E2|Bob|Ray|1|A-Ward|1/7/2021|2021-02-01
"""
PUNCHES = """client_employee_id|hours_worked|punch_apply_date|punch_in_datetime|punch_out_datetime|scheduled_start_datetime|scheduled_end_datetime
E1|8|2022-01-03|2022-01-03 09:06|2022-01-03 17:00|2022-01-03 09:00|2022-01-03 17:00
E1|9|2022-01-03|2022-01-03 09:06|2022-01-03 17:00|2022-01-03 09:00|2022-01-03 17:00
X7|4.5|2022-02-04|2022-02-04 09:00|2022-02-04 12:00||
1111|1|2022-01-04||||
|1|2022-01-04||||
"""


@pytest.fixture
def sources(tmp_path):
    put(tmp_path, "employees/a.csv", EMPLOYEES)
    put(tmp_path, "timesheets/t.csv", PUNCHES)
    return tmp_path


def run(spark, sources, root, **options):
    return refresh(spark, root, str(sources / "employees"), str(sources / "timesheets"), RULES, **options)


CURATED = ["client_employee_id", "hours_worked", "punch_in_datetime", "is_late_arrival", "month"]


def test_refresh_twice_gives_the_same_tables(spark, sources):
    root = new_folder(spark, "run")
    first = run(spark, sources, root)
    people = rows(first.layers.read("curated.employee"), "client_employee_id", "full_name", "is_placeholder", "tenure_days")
    punches = rows(first.layers.read("curated.timesheet"), *CURATED)
    assert people == [("E1", "Ann Lee", False, 1578), ("E2", "Bob Ray", False, 25), ("X7", "Unknown Unknown", True, None)]
    assert [(row[0], float(row[1]), row[3], row[4]) for row in punches] == [
        ("E1", 8.0, True, date(2022, 1, 1)), ("X7", 4.5, None, date(2022, 2, 1)),
    ]
    assert rows(first.junk_ids, "client_employee_id", "rows") == [("1111", 1), (None, 1)]
    assert set(first.report_paths) == {"md", "json"}

    second = run(spark, sources, root)
    assert second.layers.read("raw.timesheet_raw").count() == 10
    assert rows(second.layers.read("curated.employee"), "client_employee_id", "full_name", "is_placeholder", "tenure_days") == people
    assert rows(second.layers.read("curated.timesheet"), *CURATED) == punches
    assert second.layers.read("quality.check_results").count() == 14

    put(sources, "employees/b.csv", "client_employee_id|first_name|last_name|hire_date\nX7|Cy|Fox|2023-01-01\n")
    third = run(spark, sources, root, mode="new_files")
    real = third.layers.read("curated.employee").where(F.col("client_employee_id") == "X7").first()
    assert (real["full_name"], real["is_placeholder"], real["active_status"]) == ("Cy Fox", False, True)
    assert third.layers.read("raw.employee_raw").count() == 5


def test_refresh_of_one_load_equals_refresh_of_all(spark, sources):
    roots = {only: new_folder(spark, "run") for only in (False, True)}
    for day, (name, hire) in enumerate([("Ann", "2020-01-05"), ("Anna", "2020-01-06")], start=1):
        put(sources, f"employees/day{day}.csv", f"client_employee_id|first_name|hire_date\nE1|{name}|{hire}\nE{day}0|New|2021-01-01\n")
        put(sources, f"timesheets/day{day}.csv", PUNCHES.replace("2022-", f"202{day}-").replace("X7", f"X{day}"))
        rules = Rules(as_of=date(2024, 5, day), run_at=datetime(2024, 5, day))
        for only, root in roots.items():
            refresh(spark, root, str(sources / "employees"), str(sources / "timesheets"), rules,
                    mode="new_files", only_this_load=only)
    every, latest = (Layers(spark, root) for root in roots.values())
    for table, columns in {
        "curated.timesheet": CURATED,
        "curated.employee": ["client_employee_id", "first_name", "hire_date", "is_placeholder", "created_at"],
    }.items():
        assert rows(every.read(table), *columns) == rows(latest.read(table), *columns)
    assert latest.read("staging.timesheet_staging").count() < every.read("staging.timesheet_staging").count()


class Killed(Exception):
    pass


def stopped_after(monkeypatch, commits):
    """Layers that die after so many commits."""
    made = []

    def commit(self, *args, **named):
        real(self, *args, **named)
        made.append(args[0])
        if len(made) == commits:
            raise Killed

    real = Layers._commit
    monkeypatch.setattr(Layers, "_commit", commit)


RESUMED = {
    "raw.employee_raw": ["client_employee_id", "source_file"], "raw.timesheet_raw": ["client_employee_id", "punch_in_datetime"],
    "curated.employee": ["client_employee_id", "full_name", "hire_date", "is_placeholder"], "curated.timesheet": CURATED,
}


@pytest.mark.parametrize("commits", [2, 4, 6])  # after raw, after staging, after curated.employee
def test_a_stopped_run_is_resumed(spark, sources, monkeypatch, commits):
    """Killed after each commit of the second of three loads, the next run ends as an unbroken one."""
    roots = {kind: new_folder(spark, "run") for kind in ("whole", "broken")}
    options = {"mode": "new_files", "only_this_load": True}
    put(sources, "employees/b.csv", "client_employee_id|first_name|hire_date\nE3|Cy|2023-01-01\nE1|Anna|2020-01-05\n")
    put(sources, "timesheets/u.csv", PUNCHES.replace("2022-", "2023-").replace("X7", "X8"))
    run(spark, sources, roots["whole"], **options)
    with monkeypatch.context() as patch, pytest.raises(Killed):
        stopped_after(patch, commits)
        run(spark, sources, roots["broken"], **options)
    put(sources, "timesheets/v.csv", PUNCHES.replace("2022-", "2024-").replace("X7", "X9"))
    for root in roots.values():
        run(spark, sources, root, **options)
    whole, broken = (Layers(spark, root) for root in roots.values())
    for table, columns in RESUMED.items():
        assert rows(broken.read(table), *columns) == rows(whole.read(table), *columns), table
    assert whole.read("curated.timesheet").count() == 6


def test_positions_and_tables_as_of_them(spark):
    layers, table = Layers(spark, new_folder(spark, "layers")), "staging.timesheet_staging"
    assert layers.position(table) == layers.consumed(table, "raw.timesheet_raw") == 0
    layers.append(staged(spark, 1), table, consumed={"raw.timesheet_raw": 7})
    first = layers.position(table)
    layers.append(staged(spark, 2, 3), table)
    second = layers.position(table)
    layers.advance(table, {"raw.timesheet_raw": 9})
    assert layers.consumed(table, "raw.timesheet_raw") == 9 and layers.position(table) > second > first
    layers.replace(staged(spark, 4, 5, 6, 7), table)
    assert [layers.read(table, upto=at).count() for at in (0, first, second)] == [0, 1, 3]
    assert layers.read(table, after=first, upto=second).count() == 2 and layers.read(table, after=first).count() == 4


def test_dates_are_read_the_way_round_of_their_file(spark, sources):
    put(sources, "employees/b.csv", "client_employee_id|first_name|hire_date|term_date|dob\nE3|Cy|13/04/2024|01/02/2024|x\nE4|Di|03/04/2024||\n")
    put(sources, "employees/c.csv", "client_employee_id|first_name|hire_date\nE5|Ed|03/04/2024\nE6|Fi|04/13/2024\nE7|Gil|14/04/2024\n")
    done = run(spark, sources, new_folder(spark, "run"), mode="new_files", only_this_load=True, on_violation="quarantine")
    hired = dict(rows(done.layers.read("staging.employee_staging").where("client_employee_id like 'E%'"), "client_employee_id", "hire_date"))
    assert hired == {
        "E1": date(2020, 1, 5), "E2": date(2021, 1, 7), "E3": date(2024, 4, 13), "E4": date(2024, 4, 3),
        "E5": date(2024, 3, 4), "E6": date(2024, 4, 13), "E7": None,
    }
    told = done.date_formats.where("slashed > 0 and table = 'raw.employee_raw'")
    told = told.withColumn("file", F.element_at(F.split("source_path", "/"), -1))
    assert rows(told, "file", "column", "format", "ambiguous") == [
        ("a.csv", "hire_date", "month first", True), ("b.csv", "hire_date", "day first", False),
        ("b.csv", "term_date", "month first", True), ("c.csv", "hire_date", "mixed", False),
    ]
    lost = done.unreadable.where("texts > values and table = 'raw.employee_raw'")
    assert rows(lost, "column", "texts", "values") == [("dob", 1, 0), ("hire_date", 7, 6)]


def test_loads_of_junk_alone_are_consumed(spark, sources):
    put(sources, "timesheets/t.csv", PUNCHES.splitlines()[0] + "\n1111|1|2022-01-04||||\n")
    done = run(spark, sources, new_folder(spark, "run"), mode="new_files", only_this_load=True)
    raw = "raw.timesheet_raw"
    assert done.layers.consumed("curated.timesheet", raw) == done.layers.position(raw) > 0


def test_refresh_stops_or_quarantines(spark, sources):
    bad = PUNCHES + "E1|8|2022-01-05|2022-01-05 17:00|2022-01-05 09:00||\nE2|8|bad-day|2022-01-06 08:00|2022-01-06 09:00||\n"
    put(sources, "timesheets/t.csv", bad)
    with pytest.raises(ConstraintViolation) as error:
        run(spark, sources, new_folder(spark, "run"))
    assert error.value.counts == {"punch_out_after_punch_in": 1, "punch_apply_date_not_null": 1}
    kept = run(spark, sources, new_folder(spark, "run"), on_violation="quarantine")
    assert kept.layers.read("curated.timesheet").count() == 2
    assert kept.layers.quarantined("curated.timesheet").count() == 2


def test_quarantine_keeps_the_stored_employee(spark, sources):
    root = new_folder(spark, "run")
    run(spark, sources, root, mode="new_files", on_violation="quarantine")
    bad = "client_employee_id|first_name|last_name|hire_date|term_date\nE1|Ann|Bad|2020-01-05|2019-01-01\nE9|New|Bad|2020-01-05|2019-01-01\n"
    put(sources, "employees/b.csv", bad)
    put(sources, "timesheets/u.csv", PUNCHES.splitlines()[0] + "\nE9|8|2022-03-03|2022-03-03 09:00|2022-03-03 17:00||\n")
    for _ in range(2):
        kept = run(spark, sources, root, mode="new_files", on_violation="quarantine")
    stored = {row["client_employee_id"]: row["last_name"] for row in kept.layers.read("curated.employee").collect()}
    assert stored["E1"] == "Lee" and "E9" not in stored
    assert rows(kept.layers.quarantined("curated.employee"), "client_employee_id") == [("E1",), ("E9",)]
    assert rows(kept.layers.quarantined("curated.timesheet"), "client_employee_id", "broken_rules") == [("E9", ["client_employee_id_known"])]
    put(sources, "employees/c.csv", bad.replace("2019-01-01", "2021-01-01"))
    last = run(spark, sources, root, mode="new_files", on_violation="quarantine")
    assert ("E9",) in rows(last.layers.read("curated.timesheet"), "client_employee_id")


def test_missing_punch_times_are_loaded_once(spark, sources):
    put(sources, "timesheets/t.csv", PUNCHES + "E1|3|2022-05-05||||\n")
    root = new_folder(spark, "run")
    for _ in range(2):
        done = run(spark, sources, root)
    assert done.layers.read("curated.timesheet").count() == 3


def test_later_run_of_a_day_wins(spark, sources):
    root, rules = new_folder(spark, "run"), Rules(as_of=date(2024, 5, 1))
    put(sources, "employees/z1.csv", "client_employee_id|first_name\nE5|Bo\n")
    paths = set()
    for name in ("Bo", "Bob"):
        put(sources, "employees/a2.csv" if name == "Bob" else "employees/z1.csv", f"client_employee_id|first_name\nE5|{name}\n")
        done = refresh(spark, root, str(sources / "employees"), str(sources / "timesheets"), rules, mode="new_files")
        paths.add(done.report_paths["md"])
    assert len(paths) == 2
    assert [row["first_name"] for row in done.layers.read("curated.employee").where("client_employee_id = 'E5'").collect()] == ["Bob"]


def test_refresh_without_files(spark, tmp_path):
    with_nothing = run(spark, tmp_path, new_folder(spark, "run"))
    assert with_nothing.layers.read("curated.employee").count() == 0
    failed = quality.failed_critical(with_nothing.results)
    assert failed.count() == 0
