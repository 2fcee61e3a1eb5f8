"""The audit operators, one module per area."""
