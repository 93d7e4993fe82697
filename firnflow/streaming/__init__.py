"""Search over catalog files as they land."""
