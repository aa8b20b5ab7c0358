"""The order store: append-only Parquet batches, published by a manifest."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators import checks, codes

# Table name -> columns, beside the batch folder each row lies in.
TABLES = {
    "orders": "id bigint, order_code string, customer_id bigint, quantity bigint, status string",
    "customers": "id bigint, name string, normalized_name string",
    "rejects": (
        "pos bigint, order_code string, customer_name string, quantity string, status string, "
        "errors array<string>, reasons string"
    ),
    # Status after a batch of updates, and orders removed, both by order id.
    "updates": "id bigint, order_code string, status string",
    "deletions": "id bigint, order_code string",
    # The live orders after all batches before this one, and the highest ids given out until then.
    "snapshot": (
        "id bigint, order_code string, customer_id bigint, quantity bigint, status string, cluster int"
    ),
    "marks": "name string, last bigint",
    # By how much a batch changes the number of orders in a status; a snapshot has the whole numbers.
    "status_counts": "status string, orders bigint",
    "history": (
        "id bigint, order_code string, old_status string, new_status string, changed_at string"
    ),
    # One row per input file, by its version: a file written anew under its name is another version.
    "manifest": (
        "source string, length bigint, modified timestamp, origin string, tables array<string>, "
        "published_at timestamp"
    ),
}

VERSION = ("source", "length", "modified")


class OrderStore:
    """Tables below one root folder, each a folder per batch.

    A batch counts once its manifest exists, which is written last and names
    the tables the batch wrote. What a failed batch left behind is never read:
    a later batch under its id overwrites the tables it names and names no
    others. One writer at a time.

    A snapshot is a batch that holds the live orders: what was written before it
    is not read again for the current state. Orders and history lie in files
    that follow the order code, so lookups by code skip most of a batch.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _folder(self, table: str, batch_id: int) -> str:
        return f"{self.root}/{table}/batch_id={batch_id}"

    def _stored(self, table: str) -> DataFrame | None:
        """All rows of a table with their batch, None when no batch ever wrote it."""
        schema = f"{TABLES[table]}, batch_id bigint"
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{table}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _manifest(self) -> dict[int, set[str]]:
        """The published batches, one per import, update or delete, and the tables each wrote."""
        manifest = self._stored("manifest")
        if manifest is None:
            return {}
        rows = manifest.select("batch_id", "tables").distinct().collect()
        return {row.batch_id: set(row.tables) for row in rows}

    def published(self) -> list[int]:
        return sorted(self._manifest())

    def next_batch(self) -> int:
        return max(self._manifest(), default=-1) + 1

    def _read(
        self, table: str, manifest: dict[int, set[str]] | None = None, after: int = -1
    ) -> DataFrame | None:
        """Published rows of a table in batches after a number, with their batch; None when there are none."""
        known = self._manifest() if manifest is None else manifest
        folders = [
            self._folder(table, number) for number, tables in known.items() if number > after and table in tables
        ]
        if not folders:
            return None
        reader = self.spark.read.schema(f"{TABLES[table]}, batch_id bigint")
        return reader.option("basePath", f"{self.root}/{table}").parquet(*folders)

    def _table(self, table: str, manifest: dict[int, set[str]] | None = None, after: int = -1) -> DataFrame:
        rows = self._read(table, manifest, after)
        if rows is None:
            return self.spark.createDataFrame([], TABLES[table])
        return rows.drop("batch_id")

    @staticmethod
    def _snapshot_batch(manifest: dict[int, set[str]]) -> int:
        return max((number for number, tables in manifest.items() if "snapshot" in tables), default=-1)

    def orders(self, code: str | None = None) -> DataFrame:
        """Live orders, or those of one code: the last snapshot and what was loaded after it, less
        deletions, with the last status update applied."""
        manifest = self._manifest()
        start = self._snapshot_batch(manifest)

        def read(table: str) -> DataFrame | None:
            rows = self._read(table, manifest, start)
            return rows if rows is None or code is None else rows.where(F.col("order_code") == code)

        live = self._table("orders", manifest, start)
        if start >= 0:
            held = self._table("snapshot", {start: manifest[start]})
            live = held.drop("cluster").unionByName(live)
        if code is not None:
            live = live.where(F.col("order_code") == code)
        deletions, updates = read("deletions"), read("updates")
        if deletions is not None:
            live = live.join(deletions.select("id"), "id", "left_anti")
        if updates is not None:
            last = updates.groupBy("id").agg(F.max_by("status", "batch_id").alias("_last"))
            live = (
                live.join(last, "id", "left")
                .withColumn("status", F.coalesce("_last", "status"))
                .drop("_last")
            )
        return live

    def snapshot(self, cluster_rows: int = 20_000_000) -> int:
        """Publish the live orders as a batch of their own; returns its number.

        Rows are clustered by a hash of their id, ``cluster_rows`` or so together, and follow the
        order code inside a cluster.
        """
        batch_id, live = self.next_batch(), self.orders()
        kept = self.status_counts().agg(F.coalesce(F.sum("orders"), F.lit(0))).first()[0]
        clusters = max(1, -(-kept // cluster_rows))
        cluster = F.pmod(F.xxhash64("id"), F.lit(clusters)).cast("int")
        rows = live.withColumn("cluster", cluster).repartition(clusters, "cluster")
        sorted_rows = rows.sortWithinPartitions("cluster", "order_code")
        sorted_rows.write.mode("overwrite").partitionBy("cluster").parquet(self._folder("snapshot", batch_id))
        marks = [(name, self.last_id(name)) for name in ("orders", "history")]
        self.write("marks", self.spark.createDataFrame(marks, TABLES["marks"]), batch_id)
        held = self.written("snapshot", batch_id)
        self.write("status_counts", held.groupBy("status").agg(F.count("*").alias("orders")), batch_id)
        self.publish(batch_id, ["snapshot", "marks", "status_counts"])
        return batch_id

    def status_counts(self) -> DataFrame:
        """Orders per status, added up from what the snapshot and the batches since then wrote."""
        manifest = self._manifest()
        parts = self._table("status_counts", manifest, self._snapshot_batch(manifest) - 1)
        return parts.groupBy("status").agg(F.sum("orders").alias("orders")).where("orders != 0")

    def code_changes(self, after: int) -> DataFrame:
        """Codes of orders that batches after a number loaded or deleted, and whether they are ``stored`` now."""
        parts = [
            rows.select("order_code", "batch_id", F.lit(table == "orders").alias("stored"))
            for table in ("orders", "deletions")
            if (rows := self._read(table, after=after)) is not None
        ]
        if not parts:
            return self.spark.createDataFrame([], "order_code string, stored boolean")
        changes = reduce(DataFrame.unionByName, parts)
        return changes.groupBy("order_code").agg(F.max_by("stored", "batch_id").alias("stored"))

    def history(self) -> DataFrame:
        """Status changes of all orders, also of deleted ones."""
        return self._table("history")

    def customers(self) -> DataFrame:
        return self._table("customers")

    def rejects(self) -> DataFrame:
        return self._table("rejects")

    def written_ids(self, table: str) -> DataFrame:
        """The ids a table ever gave out, also of rows deleted since."""
        return self._table(table).select("id")

    def last_id(self, table: str) -> int:
        """The highest id a table ever gave out; ids of deleted orders are not used again."""
        manifest = self._manifest()
        start = self._snapshot_batch(manifest)
        ids = self._table(table, manifest, start).select("id")
        if start >= 0:
            marks = self._table("marks", {start: manifest[start]}).where(F.col("name") == table)
            ids = ids.unionByName(marks.select(F.col("last").alias("id")))
        return ids.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]

    def has_origin(self, origin: str) -> bool:
        """Whether a published batch came from this origin."""
        manifest = self._stored("manifest")
        return manifest is not None and not manifest.where(F.col("origin") == origin).isEmpty()

    def consumed(self) -> DataFrame:
        """Versions of input files that published batches have consumed; null where only a path was given."""
        manifest = self._stored("manifest")
        if manifest is None:
            return self.spark.createDataFrame([], "source string, length bigint, modified timestamp")
        return manifest.where(F.col("source").isNotNull()).select(*VERSION).distinct()

    def pending(self, files: DataFrame) -> DataFrame:
        """Listed files (``source, length, modified``) no published batch has consumed in this version.

        A path recorded without a version is consumed whatever is written there.
        """
        known = self.consumed()
        by_path = known.where("length IS NULL").select("source")
        return files.join(known, list(VERSION), "left_anti").join(by_path, "source", "left_anti")

    def written(self, table: str, batch_id: int) -> DataFrame:
        """What one batch wrote, published or not."""
        return self.spark.read.schema(TABLES[table]).parquet(self._folder(table, batch_id))

    def write(self, table: str, rows: DataFrame, batch_id: int) -> None:
        if table in ("orders", "history", "updates", "deletions"):
            # Files and row groups follow the code, so that point lookups skip them by their bounds,
            # and by bloom filters where bounds do not tell. The id spreads a code that has many rows.
            rows = rows.repartitionByRange("order_code", "id").sortWithinPartitions("order_code", "id")
        writer = rows.write.mode("overwrite")
        if table in ("orders", "history"):
            writer = writer.option("parquet.bloom.filter.enabled#order_code", "true")
        writer.parquet(self._folder(table, batch_id))

    def _violations(self, batch_id: int, tables: Sequence[str]) -> DataFrame:
        """What a batch of orders breaks, against itself and by semi-joins against what is stored."""
        added = self.written("orders", batch_id)
        known = self.customers().select("id")
        if "customers" in tables:
            known = known.unionByName(self.written("customers", batch_id).select("id"))
        code = F.col("order_code")
        repeated = checks.duplicate_keys(added, "order_code").select(F.lit("repeated code"), code)
        stored = codes.already_stored(added, self.orders()).select(F.lit("stored code"), code)
        twice = checks.duplicate_keys(added, "id").select(F.lit("repeated id"), F.col("id").cast("string"))
        lost = checks.orphans(added, known).select(F.lit("unknown customer"), F.col("customer_id").cast("string"))
        return repeated.union(stored).union(twice).union(lost).toDF("kind", "value")

    def _count_changes(self, batch_id: int, tables: Sequence[str]) -> DataFrame:
        """By how much the batch changes the number of orders per status."""
        live, one = self.orders().select("id", "status"), F.lit(1).cast("bigint")
        parts = []
        if "orders" in tables:
            parts.append(self.written("orders", batch_id).select("status", one.alias("n")))
        if "updates" in tables:
            updates = self.written("updates", batch_id).select("id", F.col("status").alias("new"))
            both = live.join(updates, "id")
            change = F.array(F.struct("status", (-one).alias("n")), F.struct(F.col("new").alias("status"), one.alias("n")))
            parts.append(both.select(F.inline(change)))
        if "deletions" in tables:
            gone = live.join(self.written("deletions", batch_id).select("id"), "id", "left_semi")
            parts.append(gone.select("status", (-one).alias("n")))
        changes = reduce(DataFrame.unionByName, parts)
        return changes.groupBy("status").agg(F.sum("n").alias("orders"))

    def publish(
        self,
        batch_id: int,
        tables: Sequence[str],
        sources: DataFrame | None = None,
        origin: str | None = None,
    ) -> None:
        """Make the tables a batch wrote visible; record its input files and where it came from.

        ``sources`` has ``source`` and, to be told apart by version, ``length`` and ``modified``.
        Fails when the batch is published already: then another writer took the same number. Fails
        as well, and leaves the store as it is, when orders repeat a code or an id or have a customer
        that is not there. Changes of the number of orders per status are written along.
        """
        if batch_id in self._manifest():
            raise RuntimeError(f"batch {batch_id} was published by another writer")
        if "orders" in tables:
            broken = self._violations(batch_id, tables).first()
            if broken is not None:
                raise ValueError(f"batch {batch_id} is not published: {broken.kind} {broken.value!r}")
        if {"orders", "updates", "deletions"} & set(tables):
            self.write("status_counts", self._count_changes(batch_id, tables), batch_id)
            tables = [*tables, "status_counts"]
        if sources is None:
            sources = self.spark.createDataFrame([(None,)], "source string")
        kinds = {"source": "string", "length": "bigint", "modified": "timestamp"}
        version = [
            (F.col(name) if name in sources.columns else F.lit(None)).cast(kind).alias(name)
            for name, kind in kinds.items()
        ]
        rows = sources.select(
            *version,
            F.lit(origin).cast("string").alias("origin"),
            F.array_sort(F.array(*map(F.lit, tables)).cast("array<string>")).alias("tables"),
            F.current_timestamp().alias("published_at"),
        )
        self.write("manifest", rows, batch_id)
