"""Registered queries, each with the SQL its result is checked against."""
