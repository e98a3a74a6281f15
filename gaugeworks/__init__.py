"""Weather-station time series on Spark: ingest, upkeep, coverage and gap filling."""
