"""Community analytics on Spark: ingest, clean, feature, model and profile social data."""
