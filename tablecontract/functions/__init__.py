"""Column functions the operators are composed of; all of them stay inside Spark's own expressions."""
