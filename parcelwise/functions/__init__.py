"""Column expressions shared by the batch and the streaming jobs."""
