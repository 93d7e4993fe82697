"""Readers that turn files into the tables the operators expect."""
