"""Written intermediate tables that cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local session without one gets a temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="orderloom-")
    return _local_folders[application]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path nobody used before, inside the shared folder."""
    return f"{shared_folder(spark)}/orderloom/{label}-{uuid.uuid4().hex}"


def merged(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the data, to be merged.

    Spark weighs a side by the bytes of its files. These are compressed, so what it would broadcast
    by that can be many times larger on the driver.
    """
    return df.hint("merge")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write the rows once and continue from the written table."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
