"""Layer tables as Parquet folders that change only by a recorded commit.

A load writes a new folder and then appends one row to the commit table. Readers
follow the commits, so they see a load whole or not at all, a failed or repeated
load leaves nothing half done, and a table can be read while its successor is
written. Plain Parquet offers no MERGE and no overwrite of a table being read.
"""

from __future__ import annotations

import time
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftledger.operators.constraints import (
    BROKEN,
    ROW_RULES,
    ConstraintViolation,
    is_broken,
    mark_broken,
)
from shiftledger.schemas import BLOOMED, HASHED, MONTHLY, TABLES

_COMMITS = (
    "table string, path string, replaces boolean, seq long, consumed map<string,long>, parts array<int>, folders int"
)
FOLDERS = 32


class Layers:
    """The tables of the raw, staging, curated and quality layers under one root.

    One writer at a time, as the load steps follow one another.

    A commit also says how far its table has consumed others: their position then. So a step takes up whatever the last
    step that succeeded has not, and a stopped run is resumed by the next, whoever starts it.

    The tables in ``HASHED`` lie in ``folders`` folders by the hash of their key. A commit names those it holds rows of, or
    replaces, so one commit can replace a few and leave the rest. The number is fixed for a root.
    """

    def __init__(self, spark: SparkSession, root: str, *, folders: int = FOLDERS):
        self.spark, self.root, self.folders = spark, root.rstrip("/"), folders

    def _entries(self, table: str) -> list[Row]:
        """The commits of a table, in order."""
        try:
            log = self.spark.read.schema(_COMMITS).parquet(f"{self.root}/commits")
            entries = log.where(F.col("table") == table).orderBy("seq").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        if table in HASHED:
            other = {entry["folders"] for entry in entries if entry["path"]} - {self.folders}
            if other:
                raise ValueError(f"{table} was written in {other} folders, not in {self.folders}")
        return entries

    def _live(self, table: str, *, after: int = 0, upto: int | None = None) -> list[tuple[str, set[int]]]:
        """What makes up the table as of a position, or what of it was committed after another.

        Each load with the folders of it that no later commit replaced. Tables that are not hashed count as one folder.
        """
        entries = [entry for entry in self._entries(table) if upto is None or entry["seq"] <= upto]
        every = range(self.folders if table in HASHED else 1)
        since = dict.fromkeys(every, 0)
        for entry in entries:
            if entry["replaces"]:
                since.update(dict.fromkeys(every if entry["parts"] is None else entry["parts"], entry["seq"]))
        held = [
            (entry["path"], {part for part in (every if entry["parts"] is None else entry["parts"]) if entry["seq"] >= since[part]})
            for entry in entries if entry["path"] and entry["seq"] > after
        ]
        return [(path, parts) for path, parts in held if parts]

    def _live_paths(self, table: str, *, after: int = 0, upto: int | None = None) -> list[str]:
        return [path for path, _ in self._live(table, after=after, upto=upto)]

    def _part(self, table: str) -> Column:
        """The folder of a row of a hashed table."""
        return F.pmod(F.xxhash64(F.col(HASHED[table]).cast(TABLES[table][HASHED[table]].dataType)), F.lit(self.folders)).cast("int")

    def parts_of(self, rows: DataFrame, table: str) -> list[int]:
        """The folders of a hashed table in which the keys of ``rows`` lie."""
        return sorted(row[0] for row in rows.select(self._part(table)).distinct().collect())

    def changed_parts(self, table: str, after: int) -> list[int]:
        """The folders of a hashed table that commits later than a position hold rows of or replaced."""
        entries = [entry for entry in self._entries(table) if entry["seq"] > after and (entry["path"] or entry["replaces"])]
        if any(entry["parts"] is None for entry in entries):
            return list(range(self.folders))
        return sorted({part for entry in entries for part in entry["parts"]})

    def replaced(self, table: str, after: int) -> bool:
        """Whether a commit later than a position replaced rows of the table."""
        return any(entry["replaces"] for entry in self._entries(table) if entry["seq"] > after)

    def position(self, table: str) -> int:
        """The last commit of a table, 0 before the first."""
        return max((entry["seq"] for entry in self._entries(table)), default=0)

    def consumed(self, table: str, source: str) -> int:
        """The position up to which ``table`` has taken up ``source``, by its last commit that says so; 0 if none does."""
        said = [entry["consumed"][source] for entry in self._entries(table) if source in (entry["consumed"] or {})]
        return said[-1] if said else 0

    def last_consumed(self, table: str) -> dict[str, int]:
        """What the last commit of a table says that it has consumed."""
        entries = self._entries(table)
        return dict(entries[-1]["consumed"] or {}) if entries else {}

    def advance(self, table: str, consumed: dict[str, int]) -> None:
        """Records that nothing had to be written for what was consumed."""
        self._commit(table, None, replaces=False, consumed=consumed)

    def _folder(self, table: str) -> str:
        return f"{self.root}/{table.replace('.', '/')}"

    def _commit(
        self, table: str, path: str | None, *, replaces: bool, consumed: dict[str, int] | None = None, parts: list[int] | None = None
    ) -> None:
        """Records a folder of rows; with ``replaces`` and no folder the table, or its ``parts``, become empty."""
        entry = [(table, path, replaces, time.time_ns(), consumed or None, parts, self.folders if table in HASHED else None)]
        self.spark.createDataFrame(entry, _COMMITS).coalesce(1).write.mode("append").parquet(f"{self.root}/commits")

    def read(self, table: str, *, after: int = 0, upto: int | None = None, parts: list[int] | None = None) -> DataFrame:
        """The table as last committed; empty before the first commit.

        With ``upto`` it is the table as of that position, with ``after`` only what was committed later than
        that; the folders of other commits are not read. Of a hashed table ``parts`` selects folders. A table kept in
        monthly folders also has the column ``month``.
        """
        schema = TABLES[table]
        live = self._live(table, after=after, upto=upto)
        if parts is not None:
            live = [(path, held & set(parts)) for path, held in live if held & set(parts)]
        if not live:
            return self.spark.createDataFrame([], schema)
        columns = [*schema.fieldNames(), *(["month"] if table in MONTHLY else [])]
        rows = self._scan(table, [path for path, _ in live], schema)
        if table in HASHED:  # on partition columns only, so other folders are not read
            rows = rows.where(reduce(Column.__or__, [
                (F.col("load") == path.split("/load=")[1].split("/")[0]) & F.col("part").isin(sorted(held)) for path, held in live
            ]))
        return rows.select(*columns)

    def loaded_files(self, table: str) -> DataFrame | None:
        """(path, source_file, length, modified) of the files in the committed loads, None before the first."""
        folders = [f"{self.root}/files/{table}/{path.split('/load=')[1].split('/')[0]}" for path in self._live_paths(table)]
        try:
            return self.spark.read.parquet(*folders) if folders else None
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def set_aside(self, bad: DataFrame, table: str) -> int:
        """Adds rows with the rules they break to the quarantine, unless they are there; returns how many."""
        schema = T.StructType([*TABLES[table].fields, T.StructField(BROKEN, T.ArrayType(T.StringType()))])
        rows = bad.select(*[
            (F.col(f.name) if f.name in bad.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
        ])
        held = self.quarantined(table)
        if held is not None:
            own = [f.name for f in schema if f.name not in ("created_at", "updated_at", "loaded_at")]
            left, right = rows.withColumn("_key", F.to_json(F.struct(*own))), held.select(F.to_json(F.struct(*own)).alias("_key"))
            rows = left.join(right, "_key", "left_anti").drop("_key")
        path = f"{self._folder(table)}/load=run{uuid.uuid4().hex}/quarantined=true"
        rows.write.parquet(path)
        count = self.spark.read.schema(schema).parquet(path).count()
        if count:
            self._commit(f"quarantine.{table}", path, replaces=False)
        return count

    def _scan(self, table: str, paths: list[str], schema: T.StructType) -> DataFrame:
        """Folders of one table; below its folder lie load, quarantined and perhaps month or part."""
        return self.spark.read.schema(schema).option("basePath", self._folder(table)).parquet(*paths)

    def quarantined(self, table: str) -> DataFrame | None:
        """Rows set aside so far, with the names of the rules they break."""
        paths = self._live_paths(f"quarantine.{table}")
        if not paths:
            return None
        schema = T.StructType([*TABLES[table].fields, T.StructField(BROKEN, T.ArrayType(T.StringType()))])
        return self._scan(table, paths, schema).select(*schema.fieldNames())

    def append(self, df: DataFrame, table: str, **options) -> dict[str, int]:
        """Adds a load; with ``files`` (see ``loaded_files``) it also records the files it came from."""
        return self._write(df, table, replaces=False, **options)

    def replace(self, df: DataFrame, table: str, **options) -> dict[str, int]:
        """Puts the rows in place of the table's, or, with ``parts``, of those in some folders of a hashed table."""
        return self._write(df, table, replaces=True, **options)

    def _write(
        self,
        df: DataFrame,
        table: str,
        *,
        replaces: bool,
        on_violation: str = "fail",
        files: DataFrame | None = None,
        consumed: dict[str, int] | None = None,
        parts: list[int] | None = None,
    ) -> dict[str, int]:
        """Writes, audits and commits; returns the number of rows and of broken rules.

        The audit reads back what was written (only the columns the rules name),
        so it sees what readers will see, whatever tasks were repeated. ``fail``
        drops a bad load by not committing it; ``quarantine`` commits good and
        bad rows apart, bad rows only if they are not in quarantine yet. ``consumed``
        (table to position) becomes true with the rows, by the same commit.
        """
        rules = ROW_RULES.get(table, [])
        load = f"{self._folder(table)}/load=run{uuid.uuid4().hex}"
        good, bad = f"{load}/quarantined=false", f"{load}/quarantined=true"
        ready = self._conform(df, table)
        quarantine = on_violation == "quarantine" and bool(rules)
        folders = []
        if quarantine:
            ready = mark_broken(ready, rules).withColumn("quarantined", F.size(BROKEN) > 0)
            folders = ["quarantined"]
        layout = T.StructType([field for field in ready.schema if field.name != "quarantined"])
        if table in MONTHLY:
            date_column = MONTHLY[table]
            # Adaptive execution splits a hot month over several files and joins small ones.
            ready = (
                ready.withColumn("month", F.trunc(date_column, "MM"))
                .hint("rebalance", "month")
                .sortWithinPartitions(*folders, "month", date_column)
            )
            folders = [*folders, "month"]
        if table in HASHED:
            ready = ready.withColumn("part", self._part(table)).hint("rebalance", "part").sortWithinPartitions(*folders, "part")
            folders = [*folders, "part"]
        writer = ready.write.mode("errorifexists").partitionBy(*folders)
        if table in BLOOMED:
            writer = writer.option(f"parquet.bloom.filter.enabled#{BLOOMED[table]}", True).option("parquet.bloom.filter.adaptive.enabled", True)
        writer.parquet(load if quarantine else good)

        audit = self._scan(table, [load], layout).agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if(is_broken(rule)).alias(rule.name) for rule in rules],
            *([F.count_if(F.size(BROKEN) > 0).alias("quarantined")] if quarantine else []),
            *([F.sort_array(F.collect_set(self._part(table))).alias("parts")] if table in HASHED else []),
        )
        counts = audit.first().asDict()
        held = counts.pop("parts", None)
        if parts is not None and not set(held) <= set(parts):
            raise ValueError(f"{table}: rows outside the folders to replace")
        touched = held if not replaces else parts
        broken = {rule.name: counts[rule.name] for rule in rules if counts[rule.name]}
        if broken and not quarantine:
            raise ConstraintViolation(table, broken)
        bad_rows = counts.pop("quarantined", 0)
        if bad_rows:
            self.set_aside(self._scan(table, [bad], layout), table)
        if files is not None:
            files.write.parquet(f"{self.root}/files/{table}/{load.split('/load=')[1]}")
        good_rows = counts["rows"] - bad_rows
        if good_rows or replaces or consumed:
            self._commit(table, good if good_rows else None, replaces=replaces, consumed=consumed, parts=touched)
        return {**counts, "rows": good_rows}

    def _conform(self, df: DataFrame, table: str) -> DataFrame:
        """Exactly the columns and types of the table; absent columns are NULL."""
        return df.select(*[
            (F.col(field.name) if field.name in df.columns else F.lit(None)).cast(field.dataType).alias(field.name)
            for field in TABLES[table].fields
        ])
