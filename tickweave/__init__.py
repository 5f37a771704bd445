"""Exchange-trade ingestion and de-duplication on Spark."""
