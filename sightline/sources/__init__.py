"""Reading and writing streams at rest and in motion."""
