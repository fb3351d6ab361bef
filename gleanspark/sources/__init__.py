"""Relations that the engine reads and writes."""
