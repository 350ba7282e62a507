"""Day-partitioned warehouse operators written as plain Spark DataFrame code."""
