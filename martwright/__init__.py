"""Sales-mart ETL on Spark: staging, quality checks, dimensions, facts, retention."""
