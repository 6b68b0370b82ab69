"""Customer analytics tables from change-data-capture feeds, as plain Spark DataFrame functions."""
