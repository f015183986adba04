"""Column functions: coordinates, alignment text, statistics."""
