"""CSV records with line breaks inside quotes, read by as many tasks as the files have ranges.

Files are read as lines, so Spark splits them wherever it likes, and long splits are ranges of some
thousand lines each. A line by itself does not tell
whether it starts inside a quoted field, but it tells where it would end in either case: a function
of two states. Functions of lines compose in order inside a range of a file, and those of ranges
along the file, one row per range; after that every line knows whether a record starts there.
Records of one line, most of them as a rule, stay where they are, and only lines of longer records
are brought together.

A quote opens a field at the start of a record or after a comma, two quotes inside a quoted field
are one, and any other quote is an ordinary character. Records end at a line feed, with or without
a carriage return before it; in files whose header ends in both, line breaks inside quotes become
line feeds, as Spark's own reader has it. Compressed files are one range each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.operators.storage import materialize

# One row per range (some 100 bytes) may be broadcast up to so many ranges.
_MOST_RANGES = 500_000
# A record longer than this many characters is taken for a quote that never closes.
LONGEST = 1 << 26

# Lines that are one range at most, so that no task has to hold more of a large block in turn.
_RANGE_LINES = 1 << 15

_RANGE = ("file", "block", "piece")
# States of a reader at a quote: at the start of a record, outside, inside, just after a closing quote.
_START, _OUTSIDE, _INSIDE, _CLOSED = range(4)


def with_origin(text: DataFrame) -> DataFrame:
    """Lines of a text source (batch or stream) with the file, its version and the range they come from."""
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
    )


def _ends_inside(line: Column, start: int) -> Column:
    """Whether a reader that begins the line in a state is inside a quoted field at its end."""

    def at_quote(state: Column, before: Column) -> Column:
        opens = before.endswith(",")
        return (
            F.when(state == _INSIDE, F.lit(_CLOSED))
            .when((state == _CLOSED) & (before == ""), F.lit(_INSIDE))
            .when((state == _START) & (before == ""), F.lit(_INSIDE))
            .when(opens, F.lit(_INSIDE))
            .otherwise(F.lit(_OUTSIDE))
        )

    parts = F.split(line, '"')
    state = F.aggregate(F.slice(parts, F.lit(1), F.size(parts) - 1), F.lit(start), at_quote)
    return F.when(F.contains(line, F.lit('"')), state == _INSIDE).otherwise(F.lit(start == _INSIDE))


def _before(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add ``in0, in1``: inside quotes before this row, if the first row of its keys starts outside or inside.

    ``end0, end1`` say the same of the end of the row. A row that ends alike in both cases settles
    what follows; after the last such row each one that swaps the states counts.
    """
    earlier = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    settles = F.col("end0") == F.col("end1")
    swaps = F.coalesce(F.count_if(F.col("end0") & ~F.col("end1")).over(earlier), F.lit(0))
    rows = rows.withColumn("_swaps", swaps)
    settled = F.last(F.when(settles, F.struct("end0", "_swaps")), ignorenulls=True).over(earlier)
    rows = rows.withColumn("_settled", settled)
    odd = (F.col("_swaps") - F.coalesce("_settled._swaps", F.lit(0))) % 2 == 1
    found = {f"in{k}": F.coalesce("_settled.end0", F.lit(bool(k))) != odd for k in (0, 1)}
    return rows.withColumns(found).drop("_swaps", "_settled")


def _after(inside: Column) -> Column:
    return F.when(inside, F.col("end1")).otherwise(F.col("end0"))


def _located(lines: DataFrame) -> DataFrame:
    """Per line and for both states: inside before it, the record it belongs to and its number in the range."""
    rows = lines.withColumns(
        {
            "row": F.monotonically_increasing_id(),
            "piece": F.shiftright(F.monotonically_increasing_id(), _RANGE_LINES.bit_length() - 1),
            "end0": _ends_inside(F.col("value"), _START),
            "end1": _ends_inside(F.col("value"), _INSIDE),
            "blank": F.col("value").isin("", "\r"),
        }
    )
    until = Window.partitionBy(*_RANGE).orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = _before(rows, _RANGE, ["row"])
    for k in (0, 1):
        begins = ~F.col(f"in{k}") & ~F.col("blank")
        known = known.withColumn(f"n{k}", F.count_if(begins).over(until))
    return known


def _ranges(located: DataFrame) -> DataFrame:
    """Per range: whether it starts inside quotes and how many records start in the ranges before it."""
    last = [F.max_by(_after(F.col(f"in{k}")), "row").alias(f"end{k}") for k in (0, 1)]
    counts = [F.max(f"n{k}").alias(f"n{k}") for k in (0, 1)]
    ranges = materialize(located.groupBy("modified", *_RANGE).agg(*last, *counts), "ranges")
    known = _before(ranges, ["file"], ["block", "piece"]).withColumn("inside", F.col("in0"))
    known = known.withColumn("starts", F.when(F.col("inside"), F.col("n1")).otherwise(F.col("n0")))
    before = Window.partitionBy("file").orderBy("block", "piece").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("starts").over(before), F.lit(0))
    known = materialize(known.select(*_RANGE, "inside", ahead.alias("ahead")), "starts")
    return F.broadcast(known) if known.count() <= _MOST_RANGES else known


def split_records(lines: DataFrame) -> DataFrame:
    """The records of files read by ``with_origin``: ``file, length, modified, number, record``.

    ``number`` counts the records of a file from 1. The lines are written once on the way.
    Empty lines outside quotes are no records.
    """
    located = materialize(_located(lines), "lines")
    rows = located.join(_ranges(located), list(_RANGE))
    inside = F.when(F.col("inside"), F.col("in1")).otherwise(F.col("in0"))
    nth = F.when(F.col("inside"), F.col("n1")).otherwise(F.col("n0"))
    rows = rows.withColumns({"within": inside, "number": F.col("ahead") + nth}).where("within OR NOT blank")
    rows = rows.withColumn("goes_on", _after(F.col("within")))
    file = ["file", "length", "modified", "number"]
    single = rows.where("NOT within AND NOT goes_on").select(*file, F.col("value").alias("record"))
    parts = rows.where("within OR goes_on")
    sizes = parts.groupBy("file", "number").agg(F.sum(F.length("value") + 1).alias("chars"))
    endless = sizes.where(F.col("chars") > LONGEST).first()
    if endless is not None:
        raise ValueError(f"record {endless.number} of {endless.file} has {endless.chars} characters: a quote is not closed")
    in_order = F.array_sort(F.collect_list(F.struct("block", "row", "value")))
    whole = parts.groupBy(*file).agg(in_order.alias("lines"))
    joined = F.array_join(F.transform("lines", lambda part: part["value"]), "\n")
    return single.unionByName(whole.select(*file, joined.alias("record")))


_OPTIONS = {"sep": ",", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def _fields(record: Column, count: int) -> Column:
    names = [f"c{i}" for i in range(count)]
    parsed = F.from_csv(record, ", ".join(f"{name} string" for name in names), _OPTIONS)
    return F.array(*[parsed[name] for name in names])


def bind_fields(records: DataFrame, names: Sequence[str]) -> DataFrame:
    """The records after each file's first, as ``file, length, modified, number`` and the named fields.

    The first record of a file names its columns, so files may order them differently. A field that
    a file or a short record lacks is null, what a record has beyond the header is left out.
    """
    first = F.col("record")
    headers = records.where("number = 1").select(
        "file", F.rtrim(first, F.lit("\r")).alias("header"), first.endswith("\r").alias("crlf")
    )
    headers = materialize(headers, "headers")
    odd = headers.where(F.contains("header", F.lit("\r"))).first()
    if odd is not None:
        raise ValueError(f"lines of {odd.file} end in carriage returns alone")
    commas = F.length("header") - F.length(F.replace("header", F.lit(","))) + 1
    widest, files = headers.agg(F.coalesce(F.max(commas), F.lit(1)), F.count("*")).first()
    titles = F.transform(_fields(F.col("header"), widest), lambda title: F.ltrim(title, F.lit("﻿")))
    places = headers.select("file", "crlf", *[F.array_position(titles, name).alias(f"at_{i}") for i, name in enumerate(names)])
    if files <= _MOST_RANGES:
        places = F.broadcast(places)
    rows = records.where("number > 1").join(places, "file")
    plain = F.rtrim(F.when(F.col("crlf"), F.replace("record", F.lit("\r\n"), F.lit("\n"))).otherwise(first), F.lit("\r"))
    rows = rows.withColumn("fields", _fields(plain, widest))
    found = [
        F.when(F.col(f"at_{i}") > 0, F.get("fields", F.col(f"at_{i}").cast("int") - 1)).alias(name)
        for i, name in enumerate(names)
    ]
    return rows.select("file", "length", "modified", (F.col("number") - 1).alias("number"), *found)


def number_rows(bound: DataFrame, drops: DataFrame) -> DataFrame:
    """Add ``pos``, dense over all files in the order of ``drops`` (``file, drop``), and ``drop``."""
    counts = bound.groupBy("file").agg(F.count("*").alias("rows")).join(drops, "file")
    before = Window.orderBy("drop").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("file", "drop", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    offsets = materialize(offsets, "offsets")
    if offsets.count() <= _MOST_RANGES:
        offsets = F.broadcast(offsets)
    return bound.join(offsets, "file").withColumn("pos", F.col("offset") + F.col("number")).drop("offset", "number")
