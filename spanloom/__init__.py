"""Span analytics on Spark: ingest, reshape, pack and query distributed-tracing spans."""
