"""Keeping analytics copies of operational tables up to date, on Spark.

Snapshots and change feeds come in as DataFrames, are routed by declarative rules,
converted to destination values, loaded in idempotent batches, and resolved to the
latest row per key.  See README.md for the map of modules.
"""
