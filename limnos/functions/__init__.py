"""Column -> Column functions; all of them stay inside Spark's own expressions."""
