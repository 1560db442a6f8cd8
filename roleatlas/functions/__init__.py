"""Column expressions (B and C) and Arrow kernels."""
