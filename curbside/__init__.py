"""Ride-event analytics on Spark: parsing, cleaning, upserts, windowed aggregates, reports."""
