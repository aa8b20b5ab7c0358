"""The reject report: rows for machines, text for readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from orderloom.functions import domain
from orderloom.plans import intake


def report_lines(validated: DataFrame) -> DataFrame:
    """The text report as ordered entries: a title, then one block per rejected order."""
    spark = validated.sparkSession
    entries = intake.report_entries(validated).withColumn("part", F.lit(1))
    title = spark.createDataFrame(
        [(0, None, f"{domain.REPORT_TITLE}\n{domain.REPORT_RULE}\n")],
        "part int, pos bigint, entry string",
    )
    marker = (
        entries.agg(F.count("*").alias("rejected"))
        .where(F.col("rejected") == 0)
        .select(
            F.lit(2).alias("part"),
            F.lit(None).cast("bigint").alias("pos"),
            F.lit(domain.REPORT_EMPTY).alias("entry"),
        )
    )
    return title.unionByName(entries.select("part", "pos", "entry")).unionByName(marker)


def write_report(validated: DataFrame, path: str) -> int:
    """Write both forms over any earlier report; returns the number of rejected orders.

    The text is made from the written rows, so ``validated`` is evaluated once. Its
    parts, read in name order, give the whole report in feed order.
    """
    counted = Observation()
    rejects = intake.rejected(validated).observe(counted, F.count("*").alias("rows"))
    rejects.write.mode("overwrite").json(f"{path}/rows")
    written = validated.sparkSession.read.schema(rejects.schema).json(f"{path}/rows")
    lines = report_lines(written).orderBy("part", "pos").select("entry")
    lines.write.mode("overwrite").text(f"{path}/text")
    return counted.get["rows"]
