"""Column-to-column building blocks."""
