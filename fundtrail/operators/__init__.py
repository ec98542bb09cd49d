"""Feature operators: each takes legs (or transfers) and returns a DataFrame."""
