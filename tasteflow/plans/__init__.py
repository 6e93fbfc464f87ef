"""Jobs that chain operators, plus the registry of driver-facing queries."""
