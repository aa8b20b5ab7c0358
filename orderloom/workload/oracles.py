"""The same queries as DuckDB SQL over the given tables."""

from __future__ import annotations

from orderloom.functions import domain
from orderloom.functions.text import whitespace

_SPACE = "".join(rf"\x{{{ord(c):x}}}" for c in whitespace())
_DOMAIN = ", ".join(f"'{status}'" for status in domain.STATUSES)


def strip(value: str) -> str:
    return f"regexp_replace(coalesce({value}, ''), '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g')"


def collapse(value: str) -> str:
    return f"regexp_replace({strip(value)}, '[{_SPACE}]+', ' ', 'g')"


NAMED = """named AS (
  SELECT o_orderkey AS k, o_orderstatus, c_name
  FROM orders JOIN customer ON c_custkey = o_custkey)"""

INTAKE = f"""{NAMED},
intake AS (
  SELECT k AS pos,
    CASE WHEN k % 23 = 0 THEN '  '
         WHEN k % 3 = 0 THEN ' ord' || (CASE WHEN k % 11 = 0 THEN k - 1 ELSE k END) || ' '
         ELSE 'ORD' || (CASE WHEN k % 11 = 0 THEN k - 1 ELSE k END) END AS order_code,
    CASE WHEN k % 29 = 0 THEN ''
         WHEN k % 31 = 0 THEN ' ab '
         WHEN k % 2 = 0 THEN '  ' || upper(replace(c_name, '#', '   ')) || ' '
         ELSE replace(c_name, '#', ' ') END AS customer_name,
    CASE WHEN k % 37 = 0 THEN ''
         WHEN k % 41 = 0 THEN 'abc'
         WHEN k % 43 = 0 THEN '0'
         WHEN k % 47 = 0 THEN '-5'
         ELSE ' ' || (k % 50 + 1) END AS quantity,
    CASE WHEN k % 17 = 0 THEN 'shipped'
         WHEN o_orderstatus = 'F' THEN ' Completed '
         WHEN o_orderstatus = 'O' THEN 'PENDING'
         ELSE 'cancelled' END AS status
  FROM named),
registry AS (SELECT 'ORD' || o_orderkey AS order_code FROM orders WHERE o_orderkey % 13 = 0),
seeds AS (
  SELECT k AS pos, 'ORD' || k AS order_code, replace(c_name, '#', ' ') AS customer_name,
    k % 50 + 1 AS quantity,
    CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'cancelled' END
      AS status
  FROM named WHERE k % 13 = 0),
norm AS (
  SELECT pos, upper({strip("order_code")}) AS order_code, {collapse("customer_name")} AS customer_name,
    {strip("quantity")} AS quantity, lower({strip("status")}) AS status
  FROM intake)"""


def field_reasons(name: str = "customer_name", quantity: str = "quantity", status: str = "status"):
    return f"""
    CASE WHEN {name} = '' THEN 'missing customer name'
         WHEN length({name}) < 3 THEN 'customer name too short' END AS customer_reason,
    CASE WHEN {quantity} = '' THEN 'missing quantity'
         WHEN NOT regexp_full_match({quantity}, '[0-9]+') THEN 'quantity must be a valid number'
         WHEN try_cast({quantity} AS BIGINT) IS NULL THEN 'quantity out of range'
         WHEN try_cast({quantity} AS BIGINT) <= 0 THEN 'quantity must be greater than zero' END
      AS quantity_reason,
    CASE WHEN {status} NOT IN ({_DOMAIN}) THEN 'invalid status' END AS status_reason"""


_REASONS = "concat_ws('; ', code_reason, customer_reason, quantity_reason, status_reason)"

VALIDATED = f"""{INTAKE},
flagged AS (
  SELECT *, row_number() OVER (PARTITION BY order_code ORDER BY pos) > 1 AS repeated,
    order_code IN (SELECT order_code FROM registry) AS stored
  FROM norm),
judged AS (
  SELECT *,
    CASE WHEN order_code = '' THEN 'missing order code'
         WHEN repeated THEN 'duplicated order code inside CSV file'
         WHEN stored THEN 'order code already exists in database' END AS code_reason,
    {field_reasons()}
  FROM flagged),
validated AS (SELECT *, {_REASONS} AS errors FROM judged),
accepted AS (
  SELECT pos, order_code, customer_name, CAST(quantity AS BIGINT) AS quantity, status
  FROM validated WHERE errors = '')"""

# What the store holds after the seeds and the intake were imported.
STORED = f"""{VALIDATED},
loads AS (
  SELECT 0 AS batch, * FROM seeds UNION ALL SELECT 1 AS batch, * FROM accepted),
first_named AS (
  SELECT lower(customer_name) AS normalized_name,
    arg_min(customer_name, batch * 1000000000000 + pos) AS name,
    min(batch * 1000000000000 + pos) AS seen
  FROM loads GROUP BY 1),
stored_customers AS (
  SELECT row_number() OVER (ORDER BY seen) AS id, name, normalized_name FROM first_named),
stored_orders AS (
  SELECT row_number() OVER (ORDER BY batch, pos) AS id, order_code, c.id AS customer_id,
    CAST(quantity AS BIGINT) AS quantity, status, batch
  FROM loads JOIN stored_customers c ON c.normalized_name = lower(customer_name)),
view AS (
  SELECT o.id, order_code, customer_id, c.name AS customer_name, quantity, status, batch
  FROM stored_orders o JOIN stored_customers c ON c.id = o.customer_id)"""

# The intake in four drops, each validated against the seeds and the drops before it.
DROPPED = f"""{INTAKE},
dealt AS (
  SELECT *, pos % 4 AS dropped, row_number() OVER (PARTITION BY order_code, pos % 4 ORDER BY pos) > 1 AS repeated,
    {field_reasons()}
  FROM norm),
loaded AS (
  SELECT order_code, min(dropped) AS loaded FROM dealt
  WHERE NOT repeated AND order_code <> ''
    AND customer_reason IS NULL AND quantity_reason IS NULL AND status_reason IS NULL GROUP BY 1),
judged AS (
  SELECT dealt.*,
    CASE WHEN order_code = '' THEN 'missing order code'
         WHEN repeated THEN 'duplicated order code inside CSV file'
         WHEN order_code IN (SELECT order_code FROM registry) OR dropped > loaded
           THEN 'order code already exists in database' END AS code_reason
  FROM dealt LEFT JOIN loaded USING (order_code)),
validated AS (SELECT *, {_REASONS} AS errors FROM judged),
spelled AS (
  SELECT customer_name, -1 AS dropped, pos FROM seeds
  UNION ALL SELECT customer_name, dropped, pos FROM validated WHERE errors = ''),
first_named AS (
  SELECT lower(customer_name) AS normalized_name, arg_min(customer_name, (dropped, pos)) AS name
  FROM spelled GROUP BY 1)"""

_VIEW = "id, order_code, customer_id, customer_name, quantity, status"

SPELLINGS = f"""{INTAKE},
keyed AS (
  SELECT pos, {collapse("customer_name")} AS name, lower({collapse("customer_name")}) AS normalized_name
  FROM intake),
spellings AS (
  SELECT normalized_name, arg_min(name, pos) AS name, min(pos) AS first_pos
  FROM keyed GROUP BY 1),
dimension AS (
  SELECT row_number() OVER (ORDER BY first_pos) AS id, name, normalized_name FROM spellings),
known AS (
  SELECT c_custkey + 1 AS id, replace(c_name, '#', ' ') AS name,
    lower(replace(c_name, '#', ' ')) AS normalized_name
  FROM customer WHERE c_mktsegment = 'BUILDING'),
fresh AS (
  SELECT * FROM spellings
  WHERE normalized_name NOT IN (SELECT normalized_name FROM known))"""

REPLAY = """commands AS (
  SELECT ts, event_id, CAST(user_id AS VARCHAR) AS order_code,
    CASE event_type WHEN 'signup' THEN 'create' WHEN 'error' THEN 'delete' ELSE 'update' END AS op,
    CASE event_type WHEN 'click' THEN 'completed' WHEN 'purchase' THEN 'cancelled'
         WHEN 'error' THEN '' ELSE 'pending' END AS status
  FROM events),
existing AS (
  SELECT *, coalesce(last_value(CASE op WHEN 'create' THEN true WHEN 'delete' THEN false END
      IGNORE NULLS) OVER (PARTITION BY order_code ORDER BY ts, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS alive
  FROM commands),
dated AS (
  SELECT *, last_value(CASE WHEN (op = 'create' AND NOT alive) OR (op = 'update' AND alive)
      THEN status END IGNORE NULLS) OVER (PARTITION BY order_code ORDER BY ts, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous
  FROM existing),
replay AS (
  SELECT ts, event_id, order_code, op, status, CASE WHEN alive THEN previous END AS old_status,
    CASE WHEN op = 'create' AND alive THEN 'rejected'
         WHEN op = 'create' THEN 'created'
         WHEN NOT alive THEN 'not_found'
         WHEN op = 'delete' THEN 'deleted'
         WHEN previous = status THEN 'unchanged'
         ELSE 'updated' END AS outcome
  FROM dated),
audit AS (
  SELECT row_number() OVER (ORDER BY ts, event_id) AS id, order_code, old_status,
    status AS new_status, strftime(ts, '%Y-%m-%d %H:%M:%S') AS changed_at
  FROM replay WHERE outcome = 'updated'),
ends AS (
  SELECT order_code, arg_max(op, (ts, event_id)) AS op, arg_max(status, (ts, event_id)) AS status
  FROM replay WHERE outcome IN ('created', 'updated', 'deleted') GROUP BY 1),
live AS (SELECT order_code, status FROM ends WHERE op <> 'delete'),
changes AS (SELECT order_code, count(*) AS changes FROM audit GROUP BY 1)"""

UPDATES = """valid AS (
  SELECT ts, event_id, CAST(user_id AS VARCHAR) AS order_code, event_type AS status
  FROM events WHERE event_type IN ('view', 'click', 'purchase')),
paired AS (
  SELECT *, coalesce(lag(status) OVER (PARTITION BY order_code ORDER BY ts, event_id), 'view')
    AS old_status
  FROM valid),
transitions AS (SELECT * FROM paired WHERE old_status <> status),
history AS (
  SELECT row_number() OVER (ORDER BY ts, event_id) AS id, order_code, old_status,
    status AS new_status, strftime(ts, '%Y-%m-%d %H:%M:%S') AS changed_at
  FROM transitions)"""


def _ranked(order: str) -> str:
    return (
        f"WITH {STORED} SELECT row_number() OVER (ORDER BY {order}) AS position, "
        "id, order_code, quantity FROM view"
    )


def _browsed(where: str) -> str:
    return f"WITH {STORED} SELECT {_VIEW} FROM view WHERE {where}"


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


ORACLES: dict[str, str] = {
    "norm_text": _with(
        INTAKE,
        f"SELECT pos, {strip('order_code')} AS order_code, {strip('customer_name')} AS customer_name, "
        f"{strip('quantity')} AS quantity, {strip('status')} AS status FROM intake",
    ),
    "norm_order_code": _with(INTAKE, "SELECT pos, order_code FROM norm"),
    "norm_status": _with(INTAKE, "SELECT pos, status FROM norm"),
    "norm_customer_name": _with(INTAKE, "SELECT pos, customer_name FROM norm"),
    "norm_customer_key": _with(INTAKE, "SELECT pos, lower(customer_name) AS customer_key FROM norm"),
    "norm_order": _with(
        INTAKE, "SELECT pos, order_code, customer_name, quantity, status FROM norm"
    ),
    # Sharp s is the one letter of these texts with a longer case form; DuckDB maps it to one letter.
    "norm_document_text": f"""
SELECT doc_id, replace(upper({strip("text")}), 'ẞ', 'SS') AS as_code,
  {collapse("text")} AS as_name, replace(lower({collapse("text")}), 'ß', 'ss') AS as_key
FROM documents""",
    "cast_quantity": _with(
        INTAKE,
        "SELECT pos, CASE WHEN regexp_full_match(quantity, '[+-]?[0-9]+') "
        "THEN try_cast(quantity AS BIGINT) END AS quantity FROM norm",
    ),
    "rule_order_code": _with(VALIDATED, "SELECT pos, order_code, code_reason AS reason FROM judged"),
    "rule_customer": _with(
        VALIDATED, "SELECT pos, customer_name, customer_reason AS reason FROM judged"
    ),
    "rule_quantity": _with(VALIDATED, "SELECT pos, quantity, quantity_reason AS reason FROM judged"),
    "rule_status": _with(VALIDATED, "SELECT pos, status, status_reason AS reason FROM judged"),
    "dup_in_file": _with(
        VALIDATED, "SELECT pos, order_code FROM flagged WHERE repeated AND order_code <> ''"
    ),
    "dup_lines": """
SELECT l_orderkey || '/' || l_linenumber AS order_code, l_partkey, l_suppkey
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) > 1""",
    "exists_in_registry": _with(VALIDATED, "SELECT pos, order_code FROM flagged WHERE stored"),
    "error_array": _with(VALIDATED, "SELECT pos, errors FROM validated"),
    "validate_all": _with(
        VALIDATED, "SELECT pos, order_code, customer_name, quantity, status, errors FROM validated"
    ),
    "create_orders_bulk": f"""WITH {INTAKE},
parts AS (SELECT *, {field_reasons()} FROM norm),
created AS (
  SELECT order_code, min(pos) AS pos FROM parts
  WHERE order_code <> '' AND coalesce(customer_reason, quantity_reason, status_reason) IS NULL
  GROUP BY 1),
judged AS (
  SELECT p.*, CASE WHEN p.order_code = '' THEN 'missing order code'
    WHEN p.order_code IN (SELECT order_code FROM registry) OR p.pos > c.pos
      THEN 'order code already exists in database' END AS code_reason
  FROM parts p LEFT JOIN created c ON c.order_code = p.order_code)
SELECT pos, order_code, customer_name, quantity, status, {_REASONS} AS errors FROM judged""",
    "preview_counts": _with(
        VALIDATED,
        "SELECT count(*) AS total_orders, count(*) FILTER (errors = '') AS valid_orders, "
        "count(*) FILTER (errors <> '') AS invalid_orders, count(*) > 0 AS requires_confirmation "
        "FROM validated",
    ),
    "reason_summary": _with(
        VALIDATED,
        """, single AS (
  SELECT pos, unnest([code_reason, customer_reason, quantity_reason, status_reason]) AS reason
  FROM judged)
SELECT reason, count(*) AS "count", min(pos) AS first_pos
FROM single WHERE reason IS NOT NULL GROUP BY reason""",
    ),
    "accepted_orders": _with(
        VALIDATED, "SELECT pos, order_code, customer_name, quantity, status FROM accepted"
    ),
    "rejected_orders": _with(
        VALIDATED,
        "SELECT pos, order_code, customer_name, quantity, status, errors AS reasons "
        "FROM validated WHERE errors <> ''",
    ),
    "reject_reasons_text": _with(
        VALIDATED, "SELECT pos, order_code, errors AS reasons FROM validated WHERE errors <> ''"
    ),
    "reject_report": _with(
        VALIDATED,
        r"""
SELECT 0 AS part, NULL AS pos,
  'INVALID ORDERS REPORT' || chr(10) || '---------------------' || chr(10) AS entry
UNION ALL
SELECT 1, pos, 'Order code: ' || order_code || chr(10) || 'Customer name: ' || customer_name
  || chr(10) || 'Quantity: ' || quantity || chr(10) || 'Status: ' || status || chr(10)
  || 'Errors:' || chr(10) || '- ' || replace(errors, '; ', chr(10) || '- ') || chr(10)
FROM validated WHERE errors <> ''
UNION ALL
SELECT 2, NULL, 'No invalid orders found.'
WHERE NOT EXISTS (SELECT 1 FROM validated WHERE errors <> '')""",
    ),
    "orders_append": _with(
        STORED, "SELECT id, order_code, customer_id, quantity, status FROM stored_orders"
    ),
    "import_result": _with(
        STORED,
        """, totals AS (
  SELECT count(*) FILTER (errors = '') AS valid, count(*) AS total FROM validated),
stored_total AS (SELECT count(*) AS n FROM stored_orders)
SELECT 'unconfirmed' AS step, false AS success, true AS cancelled, CAST(0 AS BIGINT) AS saved,
  total - valid AS skipped, false AS input_consumed,
  'CSV import cancelled. No data was modified.' AS message, n AS stored_after_all
FROM totals, stored_total
UNION ALL
SELECT 'confirmed', true, false, valid, total - valid, true,
  'CSV import completed successfully.', n FROM totals, stored_total
UNION ALL
SELECT 'repeated', true, false, 0, total, true,
  'CSV import completed successfully.', n FROM totals, stored_total""",
    ),
    "csv_scan": _with(
        INTAKE,
        "SELECT row_number() OVER (ORDER BY pos) AS line, order_code, customer_name, quantity, "
        "status FROM intake",
    ),
    "csv_multi_line": _with(
        INTAKE,
        "SELECT row_number() OVER (ORDER BY pos) AS line, order_code, "
        "customer_name || chr(10) || '\"' || status || '\", ' || quantity AS customer_name, quantity, "
        "status FROM intake",
    ),
    "inbox_pending": _with(
        INTAKE,
        'SELECT trim(upper(status)) AS "drop", count(*) AS "rows" FROM intake '
        "WHERE trim(upper(status)) <> 'PENDING' GROUP BY 1",
    ),
    "stream_intake": _with(
        DROPPED,
        """
SELECT order_code, name AS customer_name, CAST(CAST(quantity AS BIGINT) AS VARCHAR) AS quantity, status, errors
FROM validated JOIN first_named ON normalized_name = lower(customer_name) WHERE errors = ''
UNION ALL
SELECT order_code, customer_name, quantity, status, errors FROM validated WHERE errors <> ''""",
    ),
    "stream_drops": _with(
        STORED,
        """
SELECT order_code, customer_name, CAST(quantity AS VARCHAR) AS quantity, status, '' AS errors
FROM view WHERE batch = 1
UNION ALL
SELECT order_code, customer_name, quantity, status, errors FROM validated WHERE errors <> ''""",
    ),
    "export_roundtrip": _with(
        STORED,
        "SELECT id, order_code, customer_name, quantity, status, "
        "(SELECT count(*) FROM view) AS exported FROM view",
    ),
    "orders_all": _browsed("true"),
    "order_ids": _with(STORED, "SELECT id, order_code FROM stored_orders"),
    "filter_status": _browsed("status = 'pending'"),
    "filter_customer": _browsed("contains(lower(trim(customer_name)), 'er 0000000')"),
    "filter_both": _browsed(
        "status = 'completed' AND contains(lower(trim(customer_name)), 'mer 00000012')"
    ),
    "filter_unknown_status": _browsed("status = 'shipped'"),
    "lookup_code": _browsed("order_code = 'ORD26'"),
    "lookup_codes_bulk": _browsed("order_code IN (SELECT 'ORD' || p_partkey FROM part)"),
    "sort_code_asc": _ranked("upper(order_code), id"),
    "sort_code_desc": _ranked("upper(order_code) DESC, id"),
    "sort_qty_asc": _ranked("quantity, id"),
    "sort_qty_desc": _ranked("quantity DESC, id"),
    "browse_orders": _browsed("status = 'cancelled' AND contains(lower(customer_name), 'customer')"),
    "status_stats": _with(
        STORED,
        f""", counted AS (
  SELECT status, count(*) AS n FROM stored_orders GROUP BY 1
  UNION ALL SELECT unnest([{_DOMAIN}]), 0)
SELECT coalesce(status, 'total') AS status, CAST(sum(n) AS BIGINT) AS orders
FROM counted GROUP BY ROLLUP (status)""",
    ),
    "status_stats_unknown": f"""
WITH renamed AS (
  SELECT CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending'
    WHEN 'P' THEN 'archived' END AS status FROM orders),
counted AS (
  SELECT status, count(*) AS n FROM renamed GROUP BY 1
  UNION ALL SELECT unnest([{_DOMAIN}]), 0)
SELECT coalesce(status, 'total') AS status, CAST(sum(n) AS BIGINT) AS orders
FROM counted GROUP BY ROLLUP (status)""",
    "customer_dim": _with(SPELLINGS, "SELECT normalized_name, name, first_pos FROM spellings"),
    "customer_dim_ids": _with(SPELLINGS, "SELECT id, name, normalized_name FROM dimension"),
    "part_dim_ids": """
WITH named AS (
  SELECT lower(p_name) AS normalized_name, arg_min(p_name, p_partkey) AS name,
    min(p_partkey) AS first_pos
  FROM part GROUP BY 1)
SELECT row_number() OVER (ORDER BY first_pos) AS id, name, normalized_name FROM named""",
    "customers_all": _with(
        SPELLINGS,
        "SELECT row_number() OVER (ORDER BY normalized_name, id) AS position, id, name, "
        "normalized_name FROM dimension",
    ),
    "customer_search": _with(
        SPELLINGS,
        "SELECT id, name, normalized_name FROM dimension "
        "WHERE normalized_name LIKE '%mer 0000%1_5%'",
    ),
    "customer_upsert": _with(
        SPELLINGS,
        """
SELECT id, name, normalized_name FROM known
UNION ALL
SELECT (SELECT max(id) FROM known) + row_number() OVER (ORDER BY first_pos), name, normalized_name
FROM fresh""",
    ),
    "new_customers": _with(SPELLINGS, "SELECT normalized_name, name, first_pos FROM fresh"),
    "resolve_customer": _with(
        SPELLINGS,
        "SELECT pos, id AS customer_id FROM keyed JOIN dimension USING (normalized_name)",
    ),
    "migrate_legacy": _with(
        SPELLINGS,
        "SELECT k.pos AS id, 'ord' || k.pos AS order_code, d.id AS customer_id, "
        "k.pos % 50 + 1 AS quantity, i.status FROM keyed k JOIN dimension d USING (normalized_name) "
        "JOIN intake i ON i.pos = k.pos",
    ),
    "store_migration": _with(
        SPELLINGS,
        "SELECT k.pos AS id, 'ord' || k.pos AS order_code, d.id AS customer_id, "
        "d.name AS customer_name, k.pos % 50 + 1 AS quantity, i.status, "
        "(SELECT count(*) FROM intake) AS first, 0::BIGINT AS second "
        "FROM keyed k JOIN dimension d USING (normalized_name) JOIN intake i ON i.pos = k.pos",
    ),
    "migrate_legacy_customers": _with(
        SPELLINGS, "SELECT id, name, normalized_name FROM dimension"
    ),
    "chk_unique_code": _with(
        INTAKE, 'SELECT order_code, count(*) AS "rows" FROM norm GROUP BY 1 HAVING count(*) > 1'
    ),
    "chk_unique_stored": _with(
        STORED,
        'SELECT order_code, count(*) AS "rows" FROM stored_orders GROUP BY 1 HAVING count(*) > 1',
    ),
    "chk_unique_customer": (
        'SELECT lower(p_name) AS normalized_name, count(*) AS "rows" FROM part '
        "GROUP BY 1 HAVING count(*) > 1"
    ),
    "chk_orphans": """
SELECT o_custkey + 1 AS customer_id, count(*) AS orders FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
GROUP BY 1""",
    "chk_orphans_stored": _with(
        STORED,
        "SELECT customer_id, count(*) AS orders FROM stored_orders "
        "WHERE customer_id NOT IN (SELECT id FROM stored_customers) GROUP BY 1",
    ),
    "chk_restrict": _with(
        STORED, "SELECT customer_id AS id, customer_name AS name, count(*) AS orders FROM view GROUP BY 1, 2"
    ),
    "chk_not_null": _with(
        STORED,
        "SELECT pos AS id, order_code, NULL::BIGINT AS quantity FROM norm "
        "WHERE NOT regexp_full_match(quantity, '[+-]?[0-9]+') "
        "UNION ALL SELECT id, order_code, quantity FROM stored_orders "
        "WHERE id IS NULL OR order_code IS NULL OR quantity IS NULL",
    ),
    "delete_orders": _browsed(
        "order_code NOT IN (SELECT 'ORD' || l_orderkey FROM lineitem WHERE l_returnflag = 'R')"
    ),
    "delete_outcomes": _with(
        STORED,
        """, asked AS (
  SELECT 'ORD' || l_orderkey AS order_code,
    row_number() OVER (PARTITION BY l_orderkey) = 1
      AND 'ORD' || l_orderkey IN (SELECT order_code FROM stored_orders) AS hit
  FROM lineitem WHERE l_returnflag = 'R')
SELECT order_code, CASE WHEN hit THEN 'deleted' ELSE 'not_found' END AS outcome,
  CASE WHEN hit THEN 'Order ' || order_code || ' deleted successfully.'
       ELSE 'No order found with code ' || order_code || '.' END AS message,
  count(*) AS requests
FROM asked GROUP BY 1, 2, 3""",
    ),
    "command_replay": _with(
        REPLAY, "SELECT event_id, order_code, op, status, old_status, outcome FROM replay"
    ),
    "live_orders": _with(REPLAY, "SELECT order_code, status FROM live"),
    "audit_rows": _with(
        REPLAY, "SELECT id, order_code, old_status, new_status, changed_at FROM audit"
    ),
    "update_outcomes": _with(
        REPLAY,
        """
SELECT event_id, order_code, status, outcome,
  CASE outcome WHEN 'not_found' THEN 'No order found with code ' || order_code || '.'
       WHEN 'rejected' THEN 'Order ' || order_code || ' could not be updated.'
       ELSE 'Order ' || order_code || ' updated successfully.' END AS message
FROM replay WHERE op = 'update'""",
    ),
    "history_with_current": _with(
        REPLAY,
        """
SELECT CAST(c_custkey AS VARCHAR) AS order_code,
  l.order_code IS NOT NULL OR h.order_code IS NOT NULL AS success,
  l.status AS current_status, coalesce(h.changes, 0) AS changes,
  CASE WHEN l.order_code IS NOT NULL OR h.order_code IS NOT NULL
       THEN 'Found ' || coalesce(h.changes, 0) || ' status changes for order ' || c_custkey || '.'
       ELSE 'No order or status history found for code ' || c_custkey || '.' END AS message
FROM customer
LEFT JOIN live l ON l.order_code = CAST(c_custkey AS VARCHAR)
LEFT JOIN changes h ON h.order_code = CAST(c_custkey AS VARCHAR)""",
    ),
    "history_retained": _with(
        REPLAY,
        "SELECT order_code, changes FROM changes "
        "WHERE order_code NOT IN (SELECT order_code FROM live)",
    ),
    "status_transitions": _with(
        UPDATES, "SELECT event_id, order_code, old_status, status AS new_status FROM transitions"
    ),
    "current_status": _with(
        UPDATES,
        """, last AS (
  SELECT order_code, arg_max(status, (ts, event_id)) AS status FROM valid GROUP BY 1)
SELECT CAST(c_custkey AS VARCHAR) AS order_code, coalesce(last.status, 'view') AS status
FROM customer LEFT JOIN last ON last.order_code = CAST(c_custkey AS VARCHAR)""",
    ),
    "history_for_code": _with(
        UPDATES,
        "SELECT id, order_code, row_number() OVER (ORDER BY id) AS position, old_status, new_status, "
        "changed_at FROM history WHERE order_code = '42'",
    ),
    "history_position": _with(
        UPDATES,
        "SELECT id, order_code, row_number() OVER (PARTITION BY order_code ORDER BY id) AS position, "
        "old_status, new_status FROM history",
    ),
    "history_counts": _with(
        UPDATES, "SELECT order_code, count(*) AS changes FROM history GROUP BY 1"
    ),
    "snapshot_orders": _with(
        UPDATES,
        """, last AS (
  SELECT order_code, arg_max(status, (ts, event_id)) AS status FROM valid GROUP BY 1)
SELECT c_custkey AS id, CAST(c_custkey AS VARCHAR) AS order_code, coalesce(last.status, 'view') AS status
FROM customer LEFT JOIN last ON last.order_code = CAST(c_custkey AS VARCHAR) WHERE c_custkey % 7 <> 0""",
    ),
    "status_stats_kept": _with(
        UPDATES,
        """, last AS (
  SELECT order_code, arg_max(status, (ts, event_id)) AS status FROM valid GROUP BY 1),
live AS (
  SELECT coalesce(last.status, 'view') AS status
  FROM customer LEFT JOIN last ON last.order_code = CAST(c_custkey AS VARCHAR) WHERE c_custkey % 7 <> 0)
SELECT status, count(*) AS orders FROM live GROUP BY 1
UNION ALL SELECT 'total', count(*) FROM live
UNION ALL SELECT unnest(['completed', 'pending', 'cancelled']), 0""",
    ),
    "stream_transitions": _with(
        UPDATES,
        "SELECT row_number() OVER (ORDER BY ts, event_id) AS id, order_code, old_status, status AS new_status, "
        "strftime(ts, '%Y-%m-%d %H:%M:%S') AS changed_at, event_id FROM transitions",
    ),
    "stream_replay": _with(
        REPLAY, "SELECT event_id, order_code, op, status, old_status, outcome FROM replay"
    ),
    "stream_status_drops": _with(
        UPDATES, "SELECT id, order_code, old_status, new_status, changed_at FROM history"
    ),
}

# Seed rows: quantities are integers, nothing else is checked; ids continue the seeds'.
_IGNORING = f"""WITH {INTAKE},
castable AS (
  SELECT * REPLACE (CASE WHEN quantity IN ('', 'abc') THEN '-5' ELSE quantity END AS quantity) FROM norm),
firsts AS (
  SELECT * FROM castable QUALIFY row_number() OVER (PARTITION BY order_code ORDER BY pos) = 1),
added AS (
  SELECT * FROM firsts WHERE order_code NOT IN (SELECT order_code FROM registry)),
names AS (
  SELECT 0 AS batch, pos, customer_name FROM seeds
  UNION ALL SELECT 1, pos, customer_name FROM castable),
first_named AS (
  SELECT lower(customer_name) AS normalized_name,
    arg_min(customer_name, batch * 1000000000000 + pos) AS name,
    min(batch * 1000000000000 + pos) AS seen
  FROM names GROUP BY 1),
customers AS (
  SELECT row_number() OVER (ORDER BY seen) AS id, name, normalized_name FROM first_named),
inserted AS (
  SELECT (SELECT count(*) FROM seeds) + row_number() OVER (ORDER BY pos) AS id, order_code,
    c.id AS customer_id, c.name AS customer_name, CAST(quantity AS BIGINT) AS quantity, status
  FROM added JOIN customers c ON c.normalized_name = lower(customer_name))"""

ORACLES["insert_or_ignore"] = f"{_IGNORING} SELECT * FROM inserted"
ORACLES["store_insert_or_ignore"] = f"""{_IGNORING},
stored AS (
  SELECT row_number() OVER (ORDER BY s.pos) AS id, order_code, c.id AS customer_id, c.name AS customer_name,
    CAST(quantity AS BIGINT) AS quantity, status
  FROM seeds s JOIN customers c ON c.normalized_name = lower(s.customer_name))
SELECT *, (SELECT count(*) FROM inserted) AS first, 0::BIGINT AS second
FROM (SELECT * FROM stored UNION ALL SELECT * FROM inserted)"""

_LEGACY = f"""{INTAKE},
flagged AS (
  SELECT *, row_number() OVER (PARTITION BY order_code ORDER BY pos) > 1 AS repeated,
    order_code IN (SELECT order_code FROM registry) AS stored
  FROM intake),
judged AS (
  SELECT *,
    CASE WHEN order_code = '' THEN 'missing order code'
         WHEN stored THEN 'order code already exists in database'
         WHEN repeated THEN 'duplicated order code inside CSV file' END AS code_reason,
    {field_reasons()}
  FROM flagged),
validated AS (SELECT *, {_REASONS} AS errors FROM judged)"""

ORACLES["validate_legacy"] = _with(
    _LEGACY, "SELECT pos, order_code, customer_name, quantity, status, errors FROM validated"
)
ORACLES["validate_legacy_counts"] = _with(
    _LEGACY,
    "SELECT count(*) FILTER (errors = '') AS valid_orders, "
    "count(*) FILTER (errors <> '') AS invalid_orders FROM validated",
)

_CREATED = f"""{INTAKE},
parts AS (SELECT *, {field_reasons()} FROM norm),
passing AS (
  SELECT * FROM parts
  WHERE order_code <> '' AND coalesce(customer_reason, quantity_reason, status_reason) IS NULL
    AND order_code NOT IN (SELECT order_code FROM registry)
  QUALIFY row_number() OVER (PARTITION BY order_code ORDER BY pos) = 1),
loads AS (
  SELECT 0 AS batch, * FROM seeds UNION ALL
  SELECT 1, pos, order_code, customer_name, CAST(quantity AS BIGINT), status FROM passing),
first_named AS (
  SELECT lower(customer_name) AS normalized_name,
    arg_min(customer_name, batch * 1000000000000 + pos) AS name,
    min(batch * 1000000000000 + pos) AS seen
  FROM loads GROUP BY 1),
stored_customers AS (
  SELECT row_number() OVER (ORDER BY seen) AS id, name, normalized_name FROM first_named)"""

ORACLES["store_creations"] = _with(
    _CREATED,
    "SELECT row_number() OVER (ORDER BY batch, pos) AS id, order_code, c.id AS customer_id, "
    "c.name AS customer_name, CAST(quantity AS BIGINT) AS quantity, status FROM loads "
    "JOIN stored_customers c ON c.normalized_name = lower(customer_name)",
)

_LIVED = f"""{STORED},
asked AS (
  SELECT l.*, order_code, s.status AS stored,
    CASE WHEN l_returnflag = 'N' THEN 'pending' WHEN l_returnflag = 'A' THEN 'completed'
      ELSE 'cancelled' END AS wanted
  FROM lineitem l JOIN stored_orders s ON s.order_code = 'ORD' || l_orderkey
  WHERE l_returnflag <> 'R' OR l_linestatus = 'O'),
paired AS (
  SELECT *, coalesce(lag(wanted) OVER (PARTITION BY order_code
    ORDER BY l_shipdate, l_orderkey, l_partkey, l_suppkey, l_extendedprice), stored) AS old_status
  FROM asked),
history AS (
  SELECT row_number() OVER (
      ORDER BY l_shipdate, l_orderkey, l_partkey, l_suppkey, l_extendedprice) AS id,
    order_code, old_status, wanted AS new_status,
    strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS changed_at
  FROM paired WHERE old_status <> wanted),
last AS (SELECT order_code, arg_max(new_status, id) AS status FROM history GROUP BY 1)"""

ORACLES["store_history"] = _with(
    _LIVED, "SELECT id, order_code, old_status, new_status, changed_at FROM history"
)
ORACLES["store_lifecycle"] = _with(
    _LIVED,
    """
SELECT v.id, v.order_code, customer_id, customer_name, quantity, coalesce(last.status, v.status) AS status
FROM view v LEFT JOIN last ON last.order_code = v.order_code
WHERE v.order_code NOT IN (SELECT 'ORD' || l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
)
