"""Spark-first screening of labelled sequence collections."""
