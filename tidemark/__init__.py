"""Tidemark: stream and table analytics as plain PySpark DataFrame operators."""
