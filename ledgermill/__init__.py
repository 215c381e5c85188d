"""Ledger and warehouse-cost analytics as Spark DataFrame jobs."""
