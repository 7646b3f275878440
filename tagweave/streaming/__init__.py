"""Scheduled tagging as Structured Streaming micro-batches (see ``scheduled``)."""
