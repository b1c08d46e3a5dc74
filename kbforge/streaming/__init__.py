"""streaming of the engine."""
