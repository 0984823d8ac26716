"""Column builders: built-in Spark expressions only."""
