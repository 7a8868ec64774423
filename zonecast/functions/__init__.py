"""Column-level building blocks (scalar functions, calendar, metrics, quantiles)."""
