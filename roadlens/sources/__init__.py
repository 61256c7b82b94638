"""roadlens sources."""
