"""Intake of delimited text files into the raw layer.

Two scans, both split by Spark: the first looks at every line to learn each
file's header and to find files that must be refused whole, the second loads
the good files. Only facts about files (one small record each) reach the
driver, as in Spark's own file listing.
"""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftledger.functions import without_null_tokens
from shiftledger.rules import Rules
from shiftledger.schemas import LINEAGE_FIELDS

_FILES = "path string, source_file string, length long, modified timestamp"
_FILE_KEY = ["path", "length", "modified"]
_REJECTS = "path string, source_file string, reason string"
_UNKNOWN = "source_file string, column_name string"
_CORRUPT = "_corrupt_record"


class Intake(NamedTuple):
    """What one intake found."""

    rows: DataFrame  # raw rows: text columns by name, then the lineage columns
    rejects: DataFrame  # files refused whole, with the reason
    unknown_columns: DataFrame  # file columns that the table does not have; dropped
    files_read: int
    files: DataFrame  # the files read, as listed: path, source_file, length, modified


class _File(NamedTuple):
    path: str
    header: str | None
    most_fields: int
    all_fields: int
    multi_line: bool
    bad_bytes: bool


def list_files(
    spark: SparkSession, folder: str, *, pattern: str = "*.csv", recursive: bool = False
) -> DataFrame:
    """(path, source_file, length, modified) of the matching files; contents are not read."""
    found = _listing(spark, folder, pattern, recursive)
    if found is None:
        return spark.createDataFrame([], _FILES)
    return found.select(
        "path", F.element_at(F.split("path", "/"), -1).alias("source_file"), "length",
        F.col("modificationTime").alias("modified"),
    )


def _listing(spark: SparkSession, folder: str, pattern: str, recursive: bool) -> DataFrame | None:
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive)
    try:
        return reader.load(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _empty_files(spark: SparkSession, folder: str, pattern: str, recursive: bool) -> list[str]:
    """Files without a byte, which no scan returns."""
    found = _listing(spark, folder, pattern, recursive)
    if found is None:
        return []
    filled = {_plain(row["path"]) for row in found.select("path").collect()}
    return sorted(path for path in map(unquote, found.inputFiles()) if _plain(path) not in filled)


def read_delimited(
    spark: SparkSession,
    folder: str,
    columns: Sequence[str],
    rules: Rules,
    *,
    pattern: str = "*.csv",
    recursive: bool = False,
    loaded: DataFrame | None = None,
) -> Intake:
    """Reads all files of a folder or object-store prefix into one table of text.

    Columns are matched by name, so files may order or omit them differently.
    A file with a line longer than its header, a header without a known
    column or with a repeated one, bytes that are not valid text, or no line at all is
    refused whole; the others go on. With ``loaded`` (path, length, modified)
    files listed there are left out; a file that was replaced has another length or time.
    """
    files = list_files(spark, folder, pattern=pattern, recursive=recursive)
    if loaded is not None:
        files = files.join(loaded.select(*_FILE_KEY), _FILE_KEY, "left_anti").select(*files.columns)
    listed = {row["path"]: tuple(row) for row in files.collect()}
    paths = sorted(listed)

    groups: dict[tuple[tuple[str, ...], bool], list[_File]] = defaultdict(list)
    rejects: list[tuple[str, str, str]] = []
    unknown: set[tuple[str, str]] = set()
    inspected = _inspect(spark, paths, rules)
    seen = {_plain(file.path) for file in inspected}
    blank = [path for path in paths if _plain(path) not in seen] + _empty_files(spark, folder, pattern, recursive)
    rejects += [(path, _base_name(path), "the file is empty") for path in blank]
    for file in inspected:
        names = _header_names(file, rules)
        reason = _refusal(file, names, columns)
        if reason:
            rejects.append((file.path, _base_name(file.path), reason))
            continue
        unknown.update((_base_name(file.path), name) for name in names if name not in columns)
        groups[tuple(names), file.multi_line].append(file)

    parts, read = [], []
    for (names, multi_line), held in groups.items():
        group = [file.path for file in held]
        if multi_line:
            widest = max(file.all_fields for file in held)
            long_files = _files_with_long_records(spark, group, names, rules, widest)
            rejects += [(path, _base_name(path), "a line has more fields than the header") for path in long_files]
            group = [path for path in group if path not in long_files]
        read += group
        if group:
            parts.append(_load(spark, group, names, columns, rules, multi_line=multi_line))
    rows = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], _raw_schema(columns))
    return Intake(
        rows,
        spark.createDataFrame(sorted(rejects), _REJECTS),
        spark.createDataFrame(sorted(unknown), _UNKNOWN),
        len(read),
        spark.createDataFrame(
            sorted(row for path, row in listed.items() if _plain(path) in {_plain(name) for name in read}), _FILES
        ),
    )


def _plain(path: str) -> str:
    """A path without the scheme's slashes, which listing and scanning write differently."""
    return re.sub(r"^([a-z0-9]+:)/+", r"\1/", path)


def _raw_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType(
        [T.StructField(name, T.StringType()) for name in columns]
        + [T.StructField(name, kind) for name, kind in LINEAGE_FIELDS.items()]
    )


def _base_name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def _decoded(uri_part: Column) -> Column:
    """File metadata is percent-encoded; a plus sign stands for itself there. Few names have anything to decode."""
    decoded = F.url_decode(F.replace(uri_part, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(uri_part, F.lit("%")), decoded).otherwise(uri_part)


def _literal(path: str) -> str:
    """A path in which no character acts as a file pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _outside_quotes(text: Column, rules: Rules) -> Column:
    """The text with quoted fields emptied, so that the delimiters left are real."""
    mark, quote = re.escape(rules.delimiter), re.escape(rules.quote)
    # Doubled quotes go first: what is left needs no group under a star, which Java would recurse into.
    single = F.replace(text, F.lit(rules.quote * 2), F.lit(""))
    quoted_field = rf"(^|{mark}){quote}[^{quote}]*{quote}"
    return F.when(
        F.contains(text, F.lit(rules.quote)), F.regexp_replace(single, quoted_field, "$1")
    ).otherwise(text)


def _occurrences(text: Column, mark: str) -> Column:
    gone = F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))
    return (gone / F.lit(len(mark))).cast("int")


def _inspect(spark: SparkSession, paths: Sequence[str], rules: Rules) -> list[_File]:
    """Header and shape of each file that has any line."""
    if not paths:
        return []
    lines = (
        spark.read.option("encoding", rules.encoding)
        .text([_literal(path) for path in paths])
        .select(
            F.col("_metadata.file_path").alias("uri"),
            "value",
            F.when(F.col("_metadata.file_block_start") == 0, F.monotonically_increasing_id()).alias("first_block_line"),
        )
        .where(F.trim("value") != "")
    )
    # A quoted field that its line does not close; quotes inside a value do not count.
    left_open = F.col("outside").rlike(f"(^|{re.escape(rules.delimiter)}){re.escape(rules.quote)}")
    # Worked out once per line, before the aggregation, which would do it anew for every use.
    shapes = lines.withColumn("outside", _outside_quotes(F.col("value"), rules)).select(
        "uri",
        "value",
        "first_block_line",
        (_occurrences(F.col("outside"), rules.delimiter) + 1).alias("fields"),
        F.when(F.contains("outside", F.lit(rules.quote)), left_open).otherwise(False).alias("left_open"),
        (~F.is_valid_utf8("value")).alias("bad_bytes"),
    )
    # collect_set (of two values at most) makes this a hash aggregation, which
    # the text-valued min_by alone would not be; lines are never sorted.
    per_file = shapes.groupBy("uri").agg(
        F.min_by("value", "first_block_line").alias("header"),
        F.max("fields").alias("most_fields"),
        F.sum(F.col("fields").cast("long")).alias("all_fields"),
        F.array_contains(F.collect_set("left_open"), True).alias("multi_line"),
        F.max("bad_bytes").alias("bad_bytes"),
    )
    found = [
        _File(
            unquote(row["uri"]), row["header"], row["most_fields"], row["all_fields"], row["multi_line"], row["bad_bytes"]
        )
        for row in per_file.collect()
    ]
    return sorted(found)


def _header_names(file: _File, rules: Rules) -> list[str]:
    return next(csv.reader([file.header or ""], delimiter=rules.delimiter, quotechar=rules.quote), [])


def _refusal(file: _File, names: Sequence[str], columns: Sequence[str]) -> str | None:
    if file.bad_bytes:
        return "bytes that are not valid text"
    if not set(names) & set(columns):
        return "no known column in the header"
    if len(set(names)) < len(names):
        return "a column name occurs twice in the header"
    if not file.multi_line and file.most_fields > len(names):
        return "a line has more fields than the header"
    return None


def _reader(spark: SparkSession, rules: Rules, *, multi_line: bool, widest: int):
    """``widest``: the most fields that a record of the files can have."""
    return (
        spark.read.option("header", True)
        .option("sep", rules.delimiter)
        .option("quote", rules.quote)
        .option("escape", rules.quote)
        .option("encoding", rules.encoding)
        .option("multiLine", multi_line)
        .option("maxColumns", widest + 1)
    )


def _positional(names: Sequence[str]) -> list[T.StructField]:
    """Fields by position: header texts need not be valid or distinct column names."""
    return [T.StructField(f"field_{place}", T.StringType()) for place in range(len(names))]


def _load(
    spark: SparkSession,
    paths: Sequence[str],
    names: Sequence[str],
    columns: Sequence[str],
    rules: Rules,
    *,
    multi_line: bool,
) -> DataFrame:
    source = (
        _reader(spark, rules, multi_line=multi_line, widest=len(names))
        .schema(T.StructType(_positional(names)))
        .csv([_literal(path) for path in paths])
    )
    place = {name: f"field_{at}" for at, name in enumerate(names)}

    def text(name: str) -> Column:
        if name not in place:
            return F.lit(None).cast("string").alias(name)
        return without_null_tokens(F.col(place[name]), rules.null_tokens).alias(name)

    return source.select(
        *[text(name) for name in columns],
        _decoded(F.col("_metadata.file_name")).alias("source_file"),
        _decoded(F.col("_metadata.file_path")).alias("source_path"),
        F.lit(rules.stamp).cast("timestamp").alias("loaded_at"),
        F.col("_metadata.file_block_start").alias("source_offset"),
        F.monotonically_increasing_id().alias("source_row"),
    )


def _files_with_long_records(
    spark: SparkSession, paths: Sequence[str], names: Sequence[str], rules: Rules, widest: int
) -> set[str]:
    """Files with quoted line breaks in which a record has more fields than the header."""
    layout = [*_positional(names), T.StructField(_CORRUPT, T.StringType())]
    source = (
        _reader(spark, rules, multi_line=True, widest=widest)
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .schema(T.StructType(layout))
        .csv([_literal(path) for path in paths])
    )
    fields = _occurrences(_outside_quotes(F.col(_CORRUPT), rules), rules.delimiter) + 1
    # Spark refuses a query on the corrupt-record column alone, so another column is read too.
    per_file = source.groupBy(F.col("_metadata.file_path").alias("uri")).agg(
        F.max(fields).alias("most_fields"), F.count("field_0").alias("records")
    )
    return {unquote(row["uri"]) for row in per_file.collect() if (row["most_fields"] or 0) > len(names)}
