"""Reading, writing and shaping tables."""
