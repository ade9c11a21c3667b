"""Column builders. Each takes and returns Columns and adds no shuffle."""
