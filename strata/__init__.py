"""Layered-lake building blocks for PySpark: clean, gate, load, enrich, validate and report.

Every operator takes and returns DataFrames. Only writes and gate decisions run jobs.
"""
