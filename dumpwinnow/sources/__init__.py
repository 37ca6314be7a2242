"""Dump files: table specs, line parsing, source listings and Parquet snapshots."""
