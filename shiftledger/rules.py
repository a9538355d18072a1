"""Business rules and file-format settings that change results."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from datetime import date, datetime
from typing import Any

# The texts pandas.read_csv treats as missing by default.
READER_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Null markers of the source files, and the known junk ids.
FILE_NULL_TOKENS = ("[NULL]", "", "NULL")
KNOWN_JUNK_IDS = ("999999", "999951", "TEST2", "CMCRN-3")


# Date shapes beside ISO and month/day/year: pattern and year-month-day replacement, tried in this
# order. A month name stands as M and its number there; years of two digits are of this century up to 68.
DATE_FORMATS = (
    (r"(\d{4})[-/](\d{1,2})[-/](\d{1,2})", "$1-$2-$3"),
    (r"(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$1-$2"),
    (r"(\d{4})(\d\d)(\d\d)", "$1-$2-$3"),
    (r"(\d{1,2})[- ]M(\d{1,2})[- ,]+(\d{4})", "$3-$2-$1"),
    (r"M(\d{1,2})[- ](\d{1,2})[- ,]+(\d{4})", "$3-$1-$2"),
    (r"(\d{1,2})/(\d{1,2})/([0-5]\d|6[0-8])", "20$3-$1-$2"),
    (r"(\d{1,2})/(\d{1,2})/(\d\d)", "19$3-$1-$2"),
)


@dataclass(frozen=True)
class Rules:
    """One immutable set of parameters for a run.

    ``as_of`` stands for "today" and ``run_at`` for "now", so that a run can be
    repeated with the same result.
    """

    as_of: date
    run_at: datetime | None = None
    delimiter: str = "|"
    quote: str = '"'
    encoding: str = "utf-8"
    null_tokens: tuple[str, ...] = READER_NULL_TOKENS + FILE_NULL_TOKENS
    junk_ids: tuple[str, ...] = KNOWN_JUNK_IDS
    date_formats: tuple[tuple[str, str], ...] = DATE_FORMATS
    grace_minutes: int = 5
    zero_tolerance: float = 0
    missing_schedule_limit: float = 10
    placeholder_limit: float = 50

    @property
    def stamp(self) -> datetime:
        return self.run_at or datetime(self.as_of.year, self.as_of.month, self.as_of.day)

    @classmethod
    def from_config(cls, config: Mapping[str, Any], as_of: date, run_at: datetime | None = None) -> Rules:
        """Rules from a parsed configuration with the sections ``file_format``,
        ``business_rules`` and ``quality_checks``; absent entries keep the default."""
        files = config.get("file_format", {})
        business = config.get("business_rules", {})
        checks = config.get("quality_checks", {})
        found = {
            "delimiter": files.get("delimiter"),
            "quote": files.get("quote_char"),
            "encoding": files.get("encoding"),
            "date_formats": files.get("date_formats") and tuple(map(tuple, files["date_formats"])),
            "grace_minutes": business.get("grace_period_minutes"),
            "zero_tolerance": checks.get("zero_tolerance_critical"),
            "missing_schedule_limit": checks.get("missing_schedule_percentage_threshold"),
            "placeholder_limit": checks.get("placeholder_ratio_percentage_threshold"),
        }
        if "null_values" in files:
            found["null_tokens"] = READER_NULL_TOKENS + tuple(files["null_values"])
        given = {name: value for name, value in found.items() if value is not None}
        return replace(cls(as_of=as_of, run_at=run_at), **given)
