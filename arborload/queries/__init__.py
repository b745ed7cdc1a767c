"""Runnable queries over the star tables, each with the SQL that checks it."""
