"""watchtally plans."""
