"""Column-to-column building blocks; every one is a composition of built-in functions."""
