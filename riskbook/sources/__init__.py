"""Reading, registering and describing tables."""
