"""Structured Streaming side: the same tables from a replayed stream, and the checks that compare both.

What is claimed is equality of the final tables under duplicates, disorder and restarts, not exactly-once delivery.
"""
