"""Incremental loading of files that have not been seen before."""
