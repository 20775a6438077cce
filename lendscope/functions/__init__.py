"""Column functions: each takes and returns Spark ``Column`` expressions."""
