"""Compositions: ingest, features, dataset, scoring, analysis, monitoring."""
