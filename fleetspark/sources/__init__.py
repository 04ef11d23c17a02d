"""Readers: raw files, batches, notifications, serving tables."""
