"""Event analytics on tables and streams, written as PySpark DataFrame operators."""
