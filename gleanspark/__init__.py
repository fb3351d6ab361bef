"""Focused web-text collection and analytics, declared as Spark DataFrames."""
