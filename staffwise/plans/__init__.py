"""Jobs that chain operators with I/O, and the registry of driver queries."""
