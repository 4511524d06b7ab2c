"""Whole jobs over a store: ingest, reconcile, release and backfill."""
