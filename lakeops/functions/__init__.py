"""Column expressions: every function takes and returns Columns."""
