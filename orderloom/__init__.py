"""orderloom: a PySpark engine for order intake, quality rules and order lifecycle."""
