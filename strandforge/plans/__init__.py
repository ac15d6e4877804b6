"""Parameters, the portable view and the named queries."""
