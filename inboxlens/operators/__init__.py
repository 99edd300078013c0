"""DataFrame-to-DataFrame operators: mail models, ingestion, tiles, data quality."""
