"""Small NumPy helpers for geometry that Spark has no functions for."""
