"""Whole loads put together from the operators."""
