"""Source tables and the source adapter."""
