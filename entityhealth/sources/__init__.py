"""Readers and writers. Schemas are explicit; no reader infers types."""
