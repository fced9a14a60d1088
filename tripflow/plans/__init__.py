"""Whole pipelines put together from the operators, and the queries registered for checks."""
