"""Whole logical plans, put together from the operators."""
