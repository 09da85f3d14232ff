"""Scans of source tables, column catalogs and change logs."""
