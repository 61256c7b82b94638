"""roadlens sinks."""
