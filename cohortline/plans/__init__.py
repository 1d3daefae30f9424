"""Whole runs put together from the operators, and the queries over the driver's tables."""
