"""Operators for cleaning, deduplicating and encoding a training corpus."""
