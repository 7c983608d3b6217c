"""Star-schema ETL and per-region recommendation as Spark jobs."""
