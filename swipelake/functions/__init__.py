"""Column expressions. All of them stay inside Spark's generated code."""
