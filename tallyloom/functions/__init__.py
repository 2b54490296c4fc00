"""Column functions: each takes and returns Spark columns, and none needs Python on executors."""
