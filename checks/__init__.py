"""Queries over the shared test tables, each next to the SQL that gives the same rows."""
