"""The registered queries: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions import domain, rules, text
from orderloom.operators import browse, checks, codes, customers
from orderloom.operators.ids import dense_ids
from orderloom.operators.storage import materialize, new_folder
from orderloom.plans import history, intake, lifecycle, loading, migration, service
from orderloom.sources import csv, reports
from orderloom.sources.store import OrderStore
from orderloom.streaming.drops import announce
from orderloom.streaming import tracking
from orderloom.streaming.inbox import stream_intake as run_drops
from orderloom.streaming.orders import run_inbox
from orderloom.streaming.statuses import stream_statuses
from orderloom.workload import fixtures

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EVENT_ORDER = ["ts", "event_id"]
VALIDATED = ["pos", "order_code", "customer_name", "quantity", "status", "errors"]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def as_text(validated: DataFrame) -> DataFrame:
    """Errors as one text, so results compare by value."""
    return validated.withColumn("errors", F.array_join("errors", "; "))


def validated_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intake.validate(fixtures.intake(spark, sf_dir), fixtures.registry(spark, sf_dir))


# Normalization


@query
def norm_text(spark, sf_dir):
    rows = fixtures.intake(spark, sf_dir)
    return rows.select("pos", *[text.clean_text(F.col(c)).alias(c) for c in domain.ORDER_FIELDS])


@query
def norm_order_code(spark, sf_dir):
    rows = fixtures.intake(spark, sf_dir)
    return rows.select("pos", text.order_code(F.col("order_code")).alias("order_code"))


@query
def norm_status(spark, sf_dir):
    rows = fixtures.intake(spark, sf_dir)
    return rows.select("pos", text.status(F.col("status")).alias("status"))


@query
def norm_customer_name(spark, sf_dir):
    rows = fixtures.intake(spark, sf_dir)
    return rows.select("pos", text.customer_name(F.col("customer_name")).alias("customer_name"))


@query
def norm_customer_key(spark, sf_dir):
    rows = fixtures.intake(spark, sf_dir)
    return rows.select("pos", text.customer_key(F.col("customer_name")).alias("customer_key"))


@query
def norm_order(spark, sf_dir):
    return intake.normalize_orders(fixtures.intake(spark, sf_dir)).select(
        "pos", *domain.ORDER_FIELDS
    )


@query
def norm_document_text(spark, sf_dir):
    """The same normalizers over prose in four languages, whole texts."""
    value = F.col("text")
    return fixtures.table(spark, sf_dir, "documents").select(
        "doc_id",
        text.order_code(value).alias("as_code"),
        text.customer_name(value).alias("as_name"),
        text.customer_key(value).alias("as_key"),
    )


@query
def cast_quantity(spark, sf_dir):
    rows = intake.normalize_orders(fixtures.intake(spark, sf_dir))
    return rows.select("pos", text.to_quantity(F.col("quantity")).alias("quantity"))


# Rules


@query
def rule_order_code(spark, sf_dir):
    flagged = codes.flag_codes(
        intake.normalize_orders(fixtures.intake(spark, sf_dir)), fixtures.registry(spark, sf_dir)
    )
    reason = rules.code_rule(F.col("order_code"), F.col("repeated"), F.col("stored"))
    return flagged.select("pos", "order_code", reason.alias("reason"))


@query
def rule_customer(spark, sf_dir):
    rows = intake.normalize_orders(fixtures.intake(spark, sf_dir))
    reason = rules.customer_rule(F.col("customer_name"))
    return rows.select("pos", "customer_name", reason.alias("reason"))


@query
def rule_quantity(spark, sf_dir):
    rows = intake.normalize_orders(fixtures.intake(spark, sf_dir))
    reason = rules.quantity_rule(F.col("quantity"))
    return rows.select("pos", "quantity", reason.alias("reason"))


@query
def rule_status(spark, sf_dir):
    rows = intake.normalize_orders(fixtures.intake(spark, sf_dir))
    return rows.select("pos", "status", rules.status_rule(F.col("status")).alias("reason"))


@query
def dup_in_file(spark, sf_dir):
    rows = intake.normalize_orders(fixtures.intake(spark, sf_dir))
    return codes.flag_codes(rows, None).where("repeated").select("pos", "order_code")


@query
def dup_lines(spark, sf_dir):
    """Order lines whose (order, line number) an earlier-shipped row already has."""
    lines = fixtures.table(spark, sf_dir, "lineitem").select(
        F.concat_ws("/", "l_orderkey", "l_linenumber").alias("order_code"),
        F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice").alias("pos"),
    )
    return codes.flag_codes(lines, None).where("repeated").select(
        "order_code", "pos.l_partkey", "pos.l_suppkey"
    )


@query
def exists_in_registry(spark, sf_dir):
    rows = intake.normalize_orders(fixtures.intake(spark, sf_dir))
    return codes.already_stored(rows, fixtures.registry(spark, sf_dir)).select("pos", "order_code")


@query
def error_array(spark, sf_dir):
    return as_text(validated_intake(spark, sf_dir)).select("pos", "errors")


@query
def validate_all(spark, sf_dir):
    return as_text(validated_intake(spark, sf_dir)).select(*VALIDATED)


@query
def create_orders_bulk(spark, sf_dir):
    checked = intake.validate_creations(
        fixtures.intake(spark, sf_dir), fixtures.registry(spark, sf_dir)
    )
    return as_text(checked).select(*VALIDATED)


@query
def validate_legacy(spark, sf_dir):
    checked = intake.validate_legacy(
        fixtures.intake(spark, sf_dir), fixtures.registry(spark, sf_dir)
    )
    return as_text(checked).select(*VALIDATED)


@query
def validate_legacy_counts(spark, sf_dir):
    checked = intake.validate_legacy(
        fixtures.intake(spark, sf_dir), fixtures.registry(spark, sf_dir)
    )
    return intake.preview_counts(checked).select("valid_orders", "invalid_orders")


# Preview and reports


def previewed(spark: SparkSession, sf_dir: str) -> loading.Preview:
    """The preview of the intake against the store of seeds."""
    return service.preview(fixtures.seeded_store(spark, sf_dir), fixtures.intake(spark, sf_dir))


@query
def preview_counts(spark, sf_dir):
    return intake.preview_counts(previewed(spark, sf_dir).validated)


@query
def reason_summary(spark, sf_dir):
    return previewed(spark, sf_dir).reasons


@query
def accepted_orders(spark, sf_dir):
    return previewed(spark, sf_dir).orders_to_import.select("pos", *domain.ORDER_FIELDS)


@query
def rejected_orders(spark, sf_dir):
    return previewed(spark, sf_dir).orders_to_skip.select("pos", *domain.ORDER_FIELDS, "reasons")


@query
def reject_reasons_text(spark, sf_dir):
    return intake.rejected(validated_intake(spark, sf_dir)).select("pos", "order_code", "reasons")


@query
def reject_report(spark, sf_dir):
    return reports.report_lines(validated_intake(spark, sf_dir))


# Loading


@query
def insert_or_ignore(spark, sf_dir):
    """The intake as seed rows: quantities must be integers, nothing else is checked."""
    store = _seeded_store(spark, sf_dir)
    rows = fixtures.integer_intake(spark, sf_dir)
    added, dimension = loading.insert_or_ignore(rows, store.orders(), store.customers())
    return browse.order_view(added, dimension)


@query
def store_insert_or_ignore(spark, sf_dir):
    """The same rows stored twice; the second time adds nothing."""
    store = _seeded_store(spark, sf_dir)
    rows = materialize(fixtures.integer_intake(spark, sf_dir), "feed")
    first, second = (loading.store_or_ignore(store, rows) for _ in range(2))
    told = F.lit(first).cast("bigint").alias("first"), F.lit(second).cast("bigint").alias("second")
    return service.all_orders(store).select("*", *told)


@query
def store_migration(spark, sf_dir):
    """Orders of the old layout moved into a store, twice; the second time adds nothing."""
    store = OrderStore(spark, new_folder(spark, "store"))
    legacy = materialize(fixtures.legacy_orders(spark, sf_dir), "legacy")
    first, second = (migration.migrate_into(store, legacy) for _ in range(2))
    told = F.lit(first).cast("bigint").alias("first"), F.lit(second).cast("bigint").alias("second")
    return service.all_orders(store).select("*", *told)


def _seeded_store(spark: SparkSession, sf_dir: str) -> OrderStore:
    store = OrderStore(spark, new_folder(spark, "store"))
    result = loading.import_orders(store, fixtures.seeds(spark, sf_dir), confirmed=True)
    if not result.success:
        raise RuntimeError(result.message)
    return store


@query
def orders_append(spark, sf_dir):
    store = _seeded_store(spark, sf_dir)
    accepted = materialize(intake.accepted(validated_intake(spark, sf_dir)), "accepted")
    orders, _ = loading.append_orders(accepted, store.orders(), store.customers())
    return orders


@query
def import_result(spark, sf_dir):
    """An unconfirmed import, a confirmed one, and the same feed once more."""
    store = _seeded_store(spark, sf_dir)
    feed = materialize(fixtures.intake(spark, sf_dir), "feed")
    steps = [
        ("unconfirmed", loading.import_orders(store, feed)),
        ("confirmed", loading.import_orders(store, feed, confirmed=True)),
        ("repeated", loading.import_orders(store, feed, confirmed=True)),
    ]
    rows = [
        (step, r.success, r.cancelled, r.saved, r.skipped, r.input_consumed, r.message)
        for step, r in steps
    ]
    told = spark.createDataFrame(
        rows,
        "step string, success boolean, cancelled boolean, saved bigint, skipped bigint, "
        "input_consumed boolean, message string",
    )
    return told.withColumn("stored_after_all", F.lit(store.orders().count()).cast("bigint"))


# CSV


@query
def csv_scan(spark, sf_dir):
    """The intake written as CSV in feed order and read back, line numbers included."""
    folder = new_folder(spark, "feed")
    rows = fixtures.intake(spark, sf_dir).orderBy("pos").select(*domain.ORDER_FIELDS)
    csv.write_csv(rows, folder)
    read = csv.load_orders(spark, folder)
    return read.select(
        F.col("pos").alias("line"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in domain.ORDER_FIELDS],
    )


@query
def inbox_pending(spark, sf_dir):
    """Rows of the drops (one per status text) that no published import has consumed."""
    folder = new_folder(spark, "inbox")
    rows = fixtures.intake(spark, sf_dir).withColumn("drop", F.trim(F.upper("status")))
    (
        rows.select(*domain.ORDER_FIELDS, "drop")
        .write.partitionBy("drop")
        .option("header", True)
        .option("escape", '"')
        .csv(folder)
    )
    files = csv.list_files(spark, folder)
    consumed = files.where(F.contains("source", F.lit("drop=PENDING")))
    store = OrderStore(spark, new_folder(spark, "store"))
    paths = [csv.as_path(row.source) for row in consumed.collect()]
    result = loading.import_orders(store, csv.load_orders(spark, paths), consumed, confirmed=True)
    if not result.success:
        raise RuntimeError(result.message)
    pending = [csv.as_path(row.source) for row in store.pending(files).select("source").collect()]
    drop = F.regexp_extract("_metadata.file_path", "drop=([A-Z]+)", 1)
    rows = spark.read.option("header", True).option("escape", '"').csv(pending)
    return rows.groupBy(drop.alias("drop")).agg(F.count("*").alias("rows"))


@query
def csv_multi_line(spark, sf_dir):
    """The intake with line breaks, commas and quotes inside the customer names, written and read back."""
    folder = new_folder(spark, "feed")
    name = F.concat("customer_name", F.lit('\n"'), "status", F.lit('", '), "quantity")
    rows = fixtures.intake(spark, sf_dir).withColumn("customer_name", name).orderBy("pos")
    csv.write_csv(rows.select(*domain.ORDER_FIELDS), folder)
    read = csv.load_orders(spark, folder, multi_line=True)
    return read.select(
        F.col("pos").alias("line"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in domain.ORDER_FIELDS],
    )


def _imported(store: OrderStore, seeded: DataFrame) -> DataFrame:
    """Orders added since the seeds, and rejects, with their errors."""
    loaded = browse.order_view(codes.not_stored(store.orders(), seeded), store.customers())
    accepted = loaded.select(
        "order_code",
        "customer_name",
        F.col("quantity").cast("string").alias("quantity"),
        "status",
        F.lit("").alias("errors"),
    )
    rejects = store.rejects().select(
        "order_code", "customer_name", "quantity", "status", F.col("reasons").alias("errors")
    )
    return accepted.unionByName(rejects)


@query
def stream_intake(spark, sf_dir):
    """The intake as four CSV files, one after another, imported by the stream two at a time."""
    inbox, checkpoint = new_folder(spark, "inbox"), new_folder(spark, "checkpoint")
    rows = fixtures.intake(spark, sf_dir).withColumn("customer_name", F.replace("customer_name", F.lit(" "), F.lit("\n")))
    # Derived and dealt by all tasks first: the one that writes a file reads no more than its rows.
    ranged = rows.withColumn("number", F.col("pos") % 4).where("number >= 0").repartitionByRange("number", "pos")
    dealt = materialize(ranged.select("number", "pos", *domain.ORDER_FIELDS), "dealt")
    for number in range(4):
        part = dealt.where(F.col("number") == number).select("pos", *domain.ORDER_FIELDS)
        ordered = part.coalesce(1).sortWithinPartitions("pos").select(*domain.ORDER_FIELDS)
        csv.write_csv(ordered, f"{inbox}/{9 - number}")
    store = _seeded_store(spark, sf_dir)
    seeded = store.orders().select("order_code")
    run_inbox(spark, inbox, store, checkpoint, 2)
    return _imported(store, seeded)


@query
def stream_drops(spark, sf_dir):
    """The intake dropped as CSV in many files, announced as one drop and imported into a seeded store."""
    inbox, checkpoint = new_folder(spark, "inbox"), new_folder(spark, "checkpoint")
    rows = fixtures.intake(spark, sf_dir).repartitionByRange(8, "pos").sortWithinPartitions("pos")
    csv.write_csv(rows.select(*domain.ORDER_FIELDS), inbox)
    announce(spark, f"{checkpoint}-markers", "intake", inbox)
    store = _seeded_store(spark, sf_dir)
    seeded = store.orders().select("order_code")
    run_drops(spark, f"{checkpoint}-markers", store, checkpoint, 1).awaitTermination()
    return _imported(store, seeded)


@query
def export_roundtrip(spark, sf_dir):
    store = fixtures.loaded_store(spark, sf_dir)
    view = browse.order_view(store.orders(), store.customers())
    folder = new_folder(spark, "export")
    exported = csv.export_orders(view, folder)
    read = spark.read.option("header", True).option("escape", '"').csv(folder)
    return read.select(
        F.col("id").cast("bigint").alias("id"),
        "order_code",
        "customer_name",
        F.col("quantity").cast("bigint").alias("quantity"),
        "status",
        F.lit(exported).cast("bigint").alias("exported"),
    )


# Browsing stored orders


def stored_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = fixtures.loaded_store(spark, sf_dir)
    return browse.order_view(store.orders(), store.customers())


def _ranked(spark, sf_dir, sort_by, direction):
    return browse.rank_orders(stored_view(spark, sf_dir), sort_by, direction).select(
        "position", "id", "order_code", "quantity"
    )


@query
def orders_all(spark, sf_dir):
    return browse.by_id(stored_view(spark, sf_dir))


@query
def order_ids(spark, sf_dir):
    return fixtures.loaded_store(spark, sf_dir).orders().select("id", "order_code")


@query
def filter_status(spark, sf_dir):
    return browse.filter_orders(stored_view(spark, sf_dir), " Pending ", normalized=True)


@query
def filter_customer(spark, sf_dir):
    return browse.filter_orders(stored_view(spark, sf_dir), "all", " ER 0000000")


@query
def filter_both(spark, sf_dir):
    return browse.filter_orders(stored_view(spark, sf_dir), "COMPLETED", "MER 00000012")


@query
def filter_unknown_status(spark, sf_dir):
    return browse.filter_orders(stored_view(spark, sf_dir), "shipped")


@query
def lookup_code(spark, sf_dir):
    return browse.find_order(stored_view(spark, sf_dir), " ord26 ")


@query
def lookup_codes_bulk(spark, sf_dir):
    wanted = fixtures.table(spark, sf_dir, "part").select(
        F.concat(F.lit(" ord"), "p_partkey", F.lit(" ")).alias("order_code")
    )
    return browse.find_orders(stored_view(spark, sf_dir), wanted)


@query
def sort_code_asc(spark, sf_dir):
    return _ranked(spark, sf_dir, "order_code", "ascending")


@query
def sort_code_desc(spark, sf_dir):
    return _ranked(spark, sf_dir, "order_code", "descending")


@query
def sort_qty_asc(spark, sf_dir):
    return _ranked(spark, sf_dir, "quantity", "ascending")


@query
def sort_qty_desc(spark, sf_dir):
    return _ranked(spark, sf_dir, "quantity", "descending")


@query
def browse_orders(spark, sf_dir):
    return browse.browse(
        stored_view(spark, sf_dir), "cancelled", "customer", "quantity", "descending", True
    )


@query
def status_stats(spark, sf_dir):
    return browse.status_counts(fixtures.loaded_store(spark, sf_dir).orders())


@query
def status_stats_kept(spark, sf_dir):
    """From the counts kept with imports, updates, deletions and snapshots, the orders not read."""
    return service.statistics(_tracked_life(spark, sf_dir))


def _tracked_life(spark: SparkSession, sf_dir: str) -> OrderStore:
    """The tracked store after three stretches of updates, with deletions and two snapshots between."""
    store = fixtures.tracked_store(spark, sf_dir)
    first, second, third = _by_time(fixtures.status_requests(spark, sf_dir))
    gone = fixtures.table(spark, sf_dir, "customer").where("c_custkey % 7 = 0")
    requests = gone.select(F.col("c_custkey").alias("pos"), F.col("c_custkey").cast("string").alias("order_code"))
    for stretch in (first, second, third):
        service.update_statuses(store, stretch, EVENT_ORDER, F.col("ts"), fixtures.EVENT_STATUSES)
        if stretch is second:
            service.delete_orders(store, requests)
        if stretch is not third:
            store.snapshot()
    return store


@query
def snapshot_orders(spark, sf_dir):
    """Live orders from the last snapshot and what was written after it."""
    return _tracked_life(spark, sf_dir).orders().select("id", "order_code", "status")


@query
def status_stats_unknown(spark, sf_dir):
    """A status outside the domain is kept, an unused one is zero."""
    renamed = fixtures.table(spark, sf_dir, "orders").selectExpr(
        """CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending'
           WHEN 'P' THEN 'archived' END AS status"""
    )
    return browse.status_counts(renamed)


# Customers


def intake_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.intake(spark, sf_dir)


@query
def customer_dim(spark, sf_dir):
    return customers.first_spellings(intake_customers(spark, sf_dir))


@query
def customer_dim_ids(spark, sf_dir):
    return customers.build(intake_customers(spark, sf_dir))


@query
def part_dim_ids(spark, sf_dir):
    """Few keys over many rows: every key is a large group."""
    return customers.build(fixtures.raw_customers(spark, sf_dir))


@query
def customers_all(spark, sf_dir):
    dimension = customers.build(intake_customers(spark, sf_dir))
    return dense_ids(dimension, ["normalized_name", "id"], "position")


@query
def customer_search(spark, sf_dir):
    dimension = customers.build(intake_customers(spark, sf_dir))
    return customers.search(dimension, "  MER   0000%1_5 ")


@query
def customer_upsert(spark, sf_dir):
    return customers.upsert(
        intake_customers(spark, sf_dir), fixtures.known_customers(spark, sf_dir)
    )


@query
def new_customers(spark, sf_dir):
    return customers.new_customers(
        intake_customers(spark, sf_dir), fixtures.known_customers(spark, sf_dir)
    ).select("normalized_name", "name", "first_pos")


@query
def resolve_customer(spark, sf_dir):
    rows = intake_customers(spark, sf_dir)
    return customers.resolve(rows, customers.build(rows)).select("pos", "customer_id")


@query
def migrate_legacy(spark, sf_dir):
    orders, _ = migration.current_layout(fixtures.legacy_orders(spark, sf_dir))
    return orders


@query
def migrate_legacy_customers(spark, sf_dir):
    _, dimension = migration.current_layout(fixtures.legacy_orders(spark, sf_dir))
    return dimension


# Integrity checks


@query
def chk_unique_code(spark, sf_dir):
    rows = intake.normalize_orders(fixtures.intake(spark, sf_dir))
    return checks.duplicate_keys(rows, "order_code")


@query
def chk_unique_stored(spark, sf_dir):
    return checks.duplicate_keys(fixtures.loaded_store(spark, sf_dir).orders(), "order_code")


@query
def chk_unique_customer(spark, sf_dir):
    named = fixtures.raw_customers(spark, sf_dir).select(
        text.customer_key(F.col("customer_name")).alias("normalized_name")
    )
    return checks.duplicate_keys(named, "normalized_name")


@query
def chk_orphans(spark, sf_dir):
    """Orders of customers a one-segment dimension lacks."""
    orders = fixtures.table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") + 1).alias("customer_id")
    )
    return checks.orphans(orders, fixtures.known_customers(spark, sf_dir))


@query
def chk_orphans_stored(spark, sf_dir):
    store = fixtures.loaded_store(spark, sf_dir)
    return checks.orphans(store.orders(), store.customers())


@query
def chk_restrict(spark, sf_dir):
    store = fixtures.loaded_store(spark, sf_dir)
    return checks.restricted(store.customers(), store.orders())


@query
def chk_not_null(spark, sf_dir):
    """Stored orders, and intake rows whose quantity is none: those are found."""
    rows = intake.normalize_orders(fixtures.intake(spark, sf_dir)).select(
        F.col("pos").alias("id"), "order_code", text.to_quantity(F.col("quantity")).alias("quantity")
    )
    stored = fixtures.loaded_store(spark, sf_dir).orders().select("id", "order_code", "quantity")
    return checks.missing_fields(stored.unionByName(rows), "id", "order_code", "quantity")


# Deletes


def delete_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delete request per order line, so most orders are asked for repeatedly."""
    return fixtures.table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(
        F.struct(
            "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"
        ).alias("pos"),
        F.concat(F.lit(" ord"), "l_orderkey").alias("order_code"),
    )


@query
def delete_orders(spark, sf_dir):
    return lifecycle.delete_orders(
        stored_view(spark, sf_dir), delete_requests(spark, sf_dir)
    )


@query
def delete_outcomes(spark, sf_dir):
    stored = fixtures.loaded_store(spark, sf_dir).orders()
    return (
        lifecycle.delete_outcomes(delete_requests(spark, sf_dir), stored)
        .groupBy("order_code", "outcome", "message")
        .agg(F.count("*").alias("requests"))
    )


# A store that lives: updates, deletes, creations

LINE_ORDER = ["l_shipdate", "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice"]


def _lived_store(spark: SparkSession, sf_dir: str) -> OrderStore:
    """Seeds and intake after one status request per order line and the deletes of returned lines."""
    store = fixtures.new_loaded_store(spark, sf_dir)
    requests = fixtures.table(spark, sf_dir, "lineitem").select(
        *LINE_ORDER,
        F.concat(F.lit("ord"), "l_orderkey").alias("order_code"),
        F.expr(
            "CASE l_returnflag WHEN 'N' THEN ' Pending' WHEN 'A' THEN 'COMPLETED' "
            "ELSE IF(l_linestatus = 'O', 'cancelled', 'shipped') END"
        ).alias("status"),
    )
    service.update_statuses(store, requests, LINE_ORDER, F.col("l_shipdate"))
    service.delete_orders(store, delete_requests(spark, sf_dir))
    return store


@query
def store_lifecycle(spark, sf_dir):
    return service.all_orders(_lived_store(spark, sf_dir))


@query
def store_history(spark, sf_dir):
    return _lived_store(spark, sf_dir).history()


@query
def store_creations(spark, sf_dir):
    """The intake created order by order in the store of seeds."""
    store = _seeded_store(spark, sf_dir)
    service.create_orders(store, fixtures.intake(spark, sf_dir))
    return service.all_orders(store)


# Command log


def replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.replay(fixtures.commands(spark, sf_dir), EVENT_ORDER)


def command_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.audit_rows(replayed(spark, sf_dir), EVENT_ORDER, F.col("ts"))


@query
def command_replay(spark, sf_dir):
    return replayed(spark, sf_dir).select(
        "event_id", "order_code", "op", "status", "old_status", "outcome"
    )


@query
def live_orders(spark, sf_dir):
    return lifecycle.live_orders(replayed(spark, sf_dir), EVENT_ORDER)


@query
def audit_rows(spark, sf_dir):
    return command_history(spark, sf_dir)


@query
def update_outcomes(spark, sf_dir):
    updates = replayed(spark, sf_dir).where("op = 'update'")
    return updates.select(
        "event_id", "order_code", "status", "outcome", lifecycle.update_message().alias("message")
    )


@query
def history_with_current(spark, sf_dir):
    """Status history asked for every customer key; most have neither order nor history."""
    log = materialize(replayed(spark, sf_dir), "replay")
    live = lifecycle.live_orders(log, EVENT_ORDER)
    wanted = fixtures.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("order_code")
    )
    return history.look_up(lifecycle.transitions(log, EVENT_ORDER), live, wanted)


@query
def history_retained(spark, sf_dir):
    log = materialize(replayed(spark, sf_dir), "replay")
    live = lifecycle.live_orders(log, EVENT_ORDER)
    return history.retained(lifecycle.transitions(log, EVENT_ORDER), live)


# Status updates


def updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.update_statuses(
        fixtures.status_requests(spark, sf_dir),
        fixtures.tracked_orders(spark, sf_dir),
        EVENT_ORDER,
        fixtures.EVENT_STATUSES,
    )


def update_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.audit_rows(updated(spark, sf_dir), EVENT_ORDER, F.col("ts"))


@query
def status_transitions(spark, sf_dir):
    return lifecycle.transitions(updated(spark, sf_dir), EVENT_ORDER).select(
        "event_id", "order_code", "old_status", "new_status"
    )


@query
def current_status(spark, sf_dir):
    return lifecycle.current_statuses(
        updated(spark, sf_dir), fixtures.tracked_orders(spark, sf_dir), EVENT_ORDER
    )


@query
def history_for_code(spark, sf_dir):
    """The numbered changes of one code, from the stored history."""
    store = fixtures.tracked_store(spark, sf_dir)
    requests = fixtures.status_requests(spark, sf_dir)
    service.update_statuses(store, requests, EVENT_ORDER, F.col("ts"), fixtures.EVENT_STATUSES)
    return service.status_history(store, " 42 ")


@query
def history_position(spark, sf_dir):
    return history.with_positions(update_history(spark, sf_dir)).select(
        "id", "order_code", "position", "old_status", "new_status"
    )


@query
def history_counts(spark, sf_dir):
    return history.change_counts(update_history(spark, sf_dir))


def _by_time(requests: DataFrame) -> list[DataFrame]:
    """The rows in three stretches of time."""
    bounds = requests.selectExpr(
        "min(ts) + (max(ts) - min(ts)) / 3 AS low",
        "min(ts) + (max(ts) - min(ts)) / 3 * 2 AS high",
    ).first()
    ts = F.col("ts")
    parts = (ts < bounds.low, (ts >= bounds.low) & (ts < bounds.high), ts >= bounds.high)
    return [requests.where(part) for part in parts]


def _streamed(spark, rows, stateful) -> DataFrame:
    """What a stateful stream makes of rows that arrive in three stretches of eight shuffled files."""
    source, folder, checkpoint = (new_folder(spark, name) for name in ("source", "found", "checkpoint"))
    for part in _by_time(rows):
        part.repartition(8).write.mode("append").parquet(source)
        stream = stateful(spark.readStream.schema(rows.schema).parquet(source))
        tracking.collect_into(stream, folder, checkpoint).awaitTermination()
    return spark.read.parquet(folder)


@query
def stream_transitions(spark, sf_dir):
    """The history that the status requests make against keyed state, in three stretches of time.

    The query stops after each and goes on from its checkpoint."""
    stored = fixtures.tracked_orders(spark, sf_dir)

    def stateful(requests: DataFrame) -> DataFrame:
        return tracking.stream_transitions(requests, EVENT_ORDER, stored, fixtures.EVENT_STATUSES)

    found = _streamed(spark, fixtures.status_requests(spark, sf_dir), stateful)
    changes = found.withColumn("changed_at", lifecycle.moment(F.col("ts")))
    return lifecycle.history_rows(changes, EVENT_ORDER, more=["event_id"])


@query
def stream_replay(spark, sf_dir):
    """The command log against keyed state."""
    found = _streamed(
        spark, fixtures.commands(spark, sf_dir), lambda log: tracking.stream_commands(log, EVENT_ORDER)
    )
    return found.select("event_id", "order_code", "op", "status", "old_status", "outcome")


@query
def stream_status_drops(spark, sf_dir):
    """The status requests as three drops of eight files with overlapping times, applied by the stream."""
    markers, checkpoint = new_folder(spark, "markers"), new_folder(spark, "checkpoint")
    requests = fixtures.status_requests(spark, sf_dir)
    store = fixtures.tracked_store(spark, sf_dir)
    for number, part in enumerate(_by_time(requests)):
        folder = new_folder(spark, "requests")
        part.repartition(8).write.parquet(folder)
        announce(spark, markers, f"drop-{number}", folder)
    stream_statuses(
        spark, markers, store, checkpoint, requests.schema, EVENT_ORDER, F.col("ts"), fixtures.EVENT_STATUSES, 1
    ).awaitTermination()
    return store.history()
