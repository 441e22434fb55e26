"""Medallion data marts as Spark jobs: landed files to bronze, silver, gold and reports."""
