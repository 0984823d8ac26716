"""Landing files, the source registry and table sinks."""
