"""Fixed word lists and default profiles."""
