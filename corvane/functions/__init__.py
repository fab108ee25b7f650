"""Column functions over texts, names and result pages."""
