"""Spark operators that turn a dirty wide table into scored classifiers."""
