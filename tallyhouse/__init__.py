"""Retail lakehouse analytics on Spark: bronze, silver and gold layers, reports and checks."""
