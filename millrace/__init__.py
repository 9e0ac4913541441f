"""A PySpark engine for building and querying a curated document corpus."""
