"""Catalog tables, JDBC and report files."""
