"""Driver-facing plans: the operators applied to the driver's test tables."""
