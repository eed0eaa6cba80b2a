"""Outcome analytics on dated event records, written as lazy Spark DataFrame operators."""
