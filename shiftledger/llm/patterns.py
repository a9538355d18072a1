"""Places of all matches of a pattern, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FOUND = "array<struct<start: int, end: int, token: string, part: string>>"


def matches(text: Column, pattern: str, part: int = 0) -> Column:
    """Leftmost non-overlapping matches: start and end (exclusive) in code points, the match, and one of its groups.

    The places follow from the lengths of the matches and of the pieces between
    them. ``text`` should be a plain column, as it is named several times; the pattern must not match the empty text.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(part))
    steps = F.zip_with(
        F.zip_with(hits, parts, lambda hit, own: F.struct(hit.alias("hit"), own.alias("part"))),
        F.split(text, pattern, -1),
        lambda found, piece: F.struct(F.length(piece).alias("gap"), found["hit"].alias("hit"), found["part"].alias("part")),
    )
    start = F.struct(F.lit(0).alias("at"), F.lit(None).cast(FOUND).alias("found"))

    def step(held: Column, one: Column) -> Column:
        begin = held["at"] + one["gap"]
        end = begin + F.coalesce(F.length(one["hit"]), F.lit(0))
        span = F.struct(begin.alias("start"), end.alias("end"), one["hit"].alias("token"), one["part"].alias("part"))
        grown = F.concat(F.coalesce(held["found"], F.array().cast(FOUND)), F.array(span))
        return F.struct(end.alias("at"), F.when(one["hit"].isNull(), held["found"]).otherwise(grown).alias("found"))

    listed = F.aggregate(steps, start, step)["found"]
    return F.when(text.rlike(pattern), F.coalesce(listed, F.array().cast(FOUND))).otherwise(F.array().cast(FOUND))
