"""Column expressions: filters, geometry, projections, times, labels."""
