"""Landing, validation and loading as incremental streams."""
