"""Operators put together: whole runs and the registered queries."""
