"""Column helpers: sort keys, JSON text, labels, scalar functions."""
