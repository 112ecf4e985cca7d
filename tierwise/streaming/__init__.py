"""Catching up with batches that have landed since the last run."""
