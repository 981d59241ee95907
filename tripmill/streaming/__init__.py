"""Structured Streaming: record cleansing, keyed load, hourly windows."""
