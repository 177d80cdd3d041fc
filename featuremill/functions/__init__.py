"""Column-level kernels (no shuffles, no actions)."""
