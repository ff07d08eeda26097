"""Scans: JSON trees, delimited text, directory tables, schedule feeds."""
