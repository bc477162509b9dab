"""Whole jobs: cleaning, ingest, scoring."""
