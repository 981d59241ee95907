"""Readers: landing files, the trip lake, catalog tables and stream records."""
