"""Regex matches as spans in code points, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN_TYPE = "array<struct<start:bigint,end:bigint,text:string>>"


def none() -> Column:
    return F.array().cast(SPAN_TYPE)


def find_all(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches of a pattern that matches no empty string, as
    array<struct<start, end, text>> (end exclusive). ``text`` is not null.

    The pieces between matches and the matches come from one pattern, so that a running sum of
    their lengths gives the positions.
    """
    pieces = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.arrays_zip(F.transform(pieces, F.length).alias("gap"), found.alias("text"))
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), none().alias("out"))

    def step(a: Column, x: Column) -> Column:
        start = a["at"] + x["gap"]
        end = start + F.length(x["text"])
        one = F.struct(start.alias("start"), end.alias("end"), x["text"].alias("text"))
        return F.struct(F.coalesce(end, start).alias("at"),
                        F.when(x["text"].isNull(), a["out"]).otherwise(F.concat(a["out"], F.array(one))).alias("out"))

    return F.aggregate(steps, zero, step, lambda a: a["out"])


def listing(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
