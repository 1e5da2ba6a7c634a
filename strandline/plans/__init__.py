"""Session settings and shared storage."""
