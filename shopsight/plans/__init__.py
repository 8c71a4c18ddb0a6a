"""End-to-end runs and the registered query catalogue."""
