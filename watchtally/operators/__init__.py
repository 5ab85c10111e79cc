"""watchtally operators."""
