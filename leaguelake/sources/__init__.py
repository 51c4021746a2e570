"""Reading landed JSON and lake tables."""
