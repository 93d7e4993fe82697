"""Whole plans: products built from several operators, domain views and the registered queries."""
