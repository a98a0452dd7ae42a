"""Spark-first operators and ready-made jobs for survey tables and incident streams."""
