"""CSV drops: reading raw orders in file order, and the order export."""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.functions import domain
from orderloom.operators.storage import materialize
from orderloom.sources import records

# Offsets of so many splits (about 100 bytes each) may be broadcast.
_MOST_OFFSETS = 1_000_000


def as_path(name: str) -> str:
    """A file name from the metadata as a path to read: decoded, and no character a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(name))


def header_groups(
    spark: SparkSession, paths: str | Sequence[str]
) -> list[str | Sequence[str]]:
    """The files of a drop, grouped by their header line.

    Columns are bound by name and Spark takes the header of one file for all,
    so files with another column order must be read apart. When all headers
    agree the paths come back as given; else the driver receives the file
    names, which it lists anyway to plan the scan. Needed only after a read that
    expects one header has failed, as it passes over the text of the drop.
    """
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )
    headers = (
        lines.where((F.col("block") == 0) & (F.trim("value") != ""))
        .groupBy("file")
        .agg(F.min_by("value", "row").alias("header"))
    )
    distinct = headers.select("header").distinct().orderBy("header").collect()
    if len(distinct) == 1:
        return [paths]
    groups: dict[str, list[str]] = {row.header: [] for row in distinct}
    for row in headers.orderBy("file").toLocalIterator():
        groups[row.header].append(as_path(row.file))
    return list(groups.values())


def _read_group(
    spark: SparkSession, paths: str | Sequence[str], multi_line: bool, check: bool
) -> DataFrame:
    reader = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("escape", '"')
        .option("multiLine", multi_line)
    )
    rows = reader.csv(paths)
    if check:
        # A second file with other column names must fail rather than shift columns.
        rows = reader.option("enforceSchema", False).schema(rows.schema).csv(paths)
    fields = [
        F.col(f"`{name}`") if name in rows.columns else F.lit(None).cast("string").alias(name)
        for name in domain.ORDER_FIELDS
    ]
    return rows.select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("source_block"),
        F.monotonically_increasing_id().alias("source_row"),
        *fields,
    )


def read_orders(
    spark: SparkSession,
    paths: str | Sequence[str],
    multi_line: bool = False,
    one_header: bool = False,
) -> DataFrame:
    """Raw orders of one or more CSV files, every field text, columns bound by name.

    Spark splits large files, unless ``multi_line=True`` says that quoted fields
    hold line breaks: then a file is one task (``load_orders`` splits those as well). ``one_header=True`` expects all
    files to share one header; reading a file that has another raises.
    """
    if one_header:
        return _read_group(spark, paths, multi_line, check=True)
    parts = [
        _read_group(spark, files, multi_line, check=False)
        for files in header_groups(spark, paths)
    ]
    if not parts:
        return _empty(spark)
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def _empty(spark: SparkSession) -> DataFrame:
    fields = ", ".join(f"{name} string" for name in domain.ORDER_FIELDS)
    return spark.createDataFrame(
        [], f"source_file string, source_block bigint, source_row bigint, {fields}"
    )


def number_lines(raw: DataFrame) -> DataFrame:
    """Replace the source columns by ``pos``, the dense row number in file order.

    Needs rows that were materialized, so that the row ids are fixed. Rows of
    one split have consecutive ids, so one offset per split is all it takes: no
    sort, and no shuffle of the rows as long as the offsets of all splits are few
    enough to broadcast.
    """
    split = ["source_file", "source_block"]
    before = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        raw.groupBy(*split)
        .agg(F.min("source_row").alias("_first"), F.count("*").alias("_rows"))
        .select(*split, "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    offsets = materialize(offsets, "offsets")
    if offsets.count() <= _MOST_OFFSETS:
        offsets = F.broadcast(offsets)
    pos = F.col("_offset") + F.col("source_row") - F.col("_first") + 1
    return raw.join(offsets, split).select(pos.alias("pos"), *domain.ORDER_FIELDS)


def load_orders(
    spark: SparkSession,
    paths: str | Sequence[str],
    multi_line: bool = False,
    one_header: bool = False,
) -> DataFrame:
    """Raw orders with ``pos``, parsed once and written to the shared folder.

    ``multi_line=True`` says that quoted fields may hold line breaks; such files are split all the
    same (see ``records``). Without it every line is a record: the files are first read as if they shared one header, which the reader
    checks; only if one has another are they grouped by header and read again.
    """
    if multi_line:
        lines = records.with_origin(spark.read.option("lineSep", "\n").text(paths))
        split = records.split_records(lines)
        if one_header and split.where("number = 1").select("record").distinct().count() > 1:
            raise ValueError("CSV header does not conform to the schema: the files have several")
        bound = materialize(records.bind_fields(split, domain.ORDER_FIELDS), "drop")
        files = bound.select("file", F.col("file").alias("drop")).distinct()
        return records.number_rows(bound, files).select("pos", *domain.ORDER_FIELDS)
    try:
        written = materialize(read_orders(spark, paths, one_header=True), "drop")
    except (PySparkException, Py4JJavaError) as error:
        if one_header or "CSV header does not conform" not in str(error):
            raise
        written = materialize(read_orders(spark, paths), "drop")
    return number_lines(written)


def list_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """The files below a folder by version: ``source, length, modified``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select(
            F.col("_metadata.file_path").alias("source"),
            F.col("_metadata.file_size").alias("length"),
            F.col("_metadata.file_modification_time").alias("modified"),
        )
    )


def write_csv(rows: DataFrame, path: str) -> None:
    """Write rows as CSV that reads back unchanged."""
    (
        rows.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def export_orders(orders: DataFrame, path: str) -> int:
    """Export the order view, by id, over any earlier export; returns the row count."""
    # Counted above the sort: sampling for the sort runs what lies below it twice.
    counted = Observation()
    rows = orders.select(*domain.EXPORT_FIELDS).orderBy("id")
    write_csv(rows.observe(counted, F.count("*").alias("rows")), path)
    return counted.get["rows"]
