"""Operators on DataFrames: ingest, write, load, audit, checks, interval joins."""
