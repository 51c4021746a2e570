"""Writing documents for a search index, and load state."""
