"""Data-quality operators and the declared contracts of every table."""
