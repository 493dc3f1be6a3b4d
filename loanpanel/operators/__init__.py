"""DataFrame operators over the loan panel."""
