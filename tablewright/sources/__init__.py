"""Reading and writing tables, runs and models."""
