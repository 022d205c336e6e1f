"""Clickstream and order analytics as plain Spark DataFrame functions."""
