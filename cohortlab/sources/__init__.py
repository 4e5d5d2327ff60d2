"""Input fixtures over the driver tables and file-based sources and sinks."""
