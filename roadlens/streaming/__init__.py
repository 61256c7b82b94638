"""roadlens streaming."""
