"""Layered sales warehouse built from plain Spark DataFrame operators."""
