"""User-level jobs composed from operators, sources and sinks."""
