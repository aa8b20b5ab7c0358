"""Fixed values of the order domain: statuses, rule messages and service messages."""

# The closed status domain.
STATUSES = ("completed", "pending", "cancelled")

# The fields of one raw order, and of one exported order.
ORDER_FIELDS = ("order_code", "customer_name", "quantity", "status")
EXPORT_FIELDS = ("id", "order_code", "customer_name", "quantity", "status")

# The text of every validation reason.
MISSING_CODE = "missing order code"
REPEATED_CODE = "duplicated order code inside CSV file"
STORED_CODE = "order code already exists in database"
MISSING_CUSTOMER = "missing customer name"
SHORT_CUSTOMER = "customer name too short"
MISSING_QUANTITY = "missing quantity"
QUANTITY_NOT_A_NUMBER = "quantity must be a valid number"
QUANTITY_NOT_POSITIVE = "quantity must be greater than zero"
INVALID_STATUS = "invalid status"

# A reason of our own: digits that do not fit a 64-bit integer cannot be stored.
QUANTITY_OUT_OF_RANGE = "quantity out of range"

MIN_CUSTOMER_LENGTH = 3

# Lines of the reject report.
REPORT_TITLE = "INVALID ORDERS REPORT"
REPORT_RULE = "---------------------"
REPORT_EMPTY = "No invalid orders found."

# What an import says about its result.
IMPORT_CANCELLED = "CSV import cancelled. No data was modified."
IMPORT_EMPTY = "No CSV orders are available to import."
IMPORT_DONE = "CSV import completed successfully."
IMPORT_FAILED = "CSV import failed: %s"

# What an update, a delete or a history lookup says (format strings).
NO_ORDER = "No order found with code %s."
UPDATED = "Order %s updated successfully."
NOT_UPDATED = "Order %s could not be updated."
DELETED = "Order %s deleted successfully."
NO_HISTORY = "No order or status history found for code %s."
FOUND_HISTORY = "Found %d status changes for order %s."

# Sort options of the order browser.
SORT_FIELDS = ("order_code", "quantity")
SORT_DIRECTIONS = ("ascending", "descending")
