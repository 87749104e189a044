"""Filings analytics on Spark: sources, cleaning, merge, statements, full text, catalog and SQL tools."""
