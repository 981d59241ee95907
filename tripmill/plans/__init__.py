"""Layered models: staging, enriched trips, marts, dashboards, cost."""
