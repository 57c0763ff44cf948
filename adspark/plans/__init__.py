"""Composite plans: report ingestion, catalog sync, stand-in queries over the driver tables."""
