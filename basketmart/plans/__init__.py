"""Marts, evidence tables, checks, statistics and model plans."""
