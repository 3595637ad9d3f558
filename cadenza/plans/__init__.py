"""Query plans that put the operators to work."""
