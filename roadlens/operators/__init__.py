"""roadlens operators."""
