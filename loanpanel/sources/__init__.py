"""Readers, writers and the column model of the loan panel."""
