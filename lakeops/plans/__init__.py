"""Business marts composed from the operators, one module per domain."""
