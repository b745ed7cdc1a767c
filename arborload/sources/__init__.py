"""Batch sources: landing area, CSV, delete feed, scratch space."""
