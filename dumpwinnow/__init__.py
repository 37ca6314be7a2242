"""Subset large relational catalog dumps with Spark.

Load headerless tab-separated dump tables, match entities against a list of names, keep
the rows the matched entities need across all tables, check and profile the result, and
answer batch name lookups.
"""
