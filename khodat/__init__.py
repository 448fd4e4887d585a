"""Property-listing lakehouse on Spark: parsing, loading and maintaining listing tables."""
