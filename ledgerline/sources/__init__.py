"""Inputs: the retail tables (from the test tables or a catalog) and script folders."""
