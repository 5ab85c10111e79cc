"""watchtally sources."""
