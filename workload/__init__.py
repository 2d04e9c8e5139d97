"""Queries over the sample tables, each next to the SQL that checks it."""
