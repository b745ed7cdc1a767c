"""Lazy DataFrame operators: flatten, project, clean, propagate keys, apply changes."""
