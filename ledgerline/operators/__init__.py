"""Reusable DataFrame operators: relational helpers, DML, recursion, exact quantiles."""
