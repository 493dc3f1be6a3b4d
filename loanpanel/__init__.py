"""Cleaning, resolving and linking yearly panels of loan records on Spark."""
