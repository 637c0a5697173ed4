"""Column expressions: projections, grid indices, timestamps and text."""
