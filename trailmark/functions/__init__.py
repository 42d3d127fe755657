"""Column expressions: grids, poses, numbers and text."""
