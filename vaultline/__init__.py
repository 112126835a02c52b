"""Bank-data tables on open-source Spark: ingest, cleaning, change capture, gold rollups, privacy."""
