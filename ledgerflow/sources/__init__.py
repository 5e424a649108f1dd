"""Readers. Paths may point at any file system Spark is configured for."""
