"""Compositions: named queries, acceptance checks, reports, the ingest job."""
