"""Column expressions: names and numbers, cell keys, geometry, reproducible draws."""
