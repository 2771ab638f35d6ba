"""Batch ETL and dimensional loads written as plain PySpark DataFrame jobs."""

# The one name every stage uses for the ingest-date column.
LOAD_DATE = "load_date"
