"""Config-driven incremental ingestion of JSON files into keyed tables, on Spark."""
