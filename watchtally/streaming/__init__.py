"""watchtally streaming."""
