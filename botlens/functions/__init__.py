"""Column-level building blocks: each takes and returns Spark Columns."""
