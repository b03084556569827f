"""Incremental change capture on parquet, expressed as Spark DataFrame jobs."""
