"""Layered analytics tables on Spark: ingest, clean, and build star schemas with SCD history."""
