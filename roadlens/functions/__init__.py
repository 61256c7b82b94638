"""roadlens functions."""
