"""Retail analytics on Spark: staging, marts, evidence tables, checks, statistics and a baseline model."""
