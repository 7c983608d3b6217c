"""Readers, writers, landing ingest, staging and publishing."""
