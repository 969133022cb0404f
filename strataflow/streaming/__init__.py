"""File-stream loads."""
