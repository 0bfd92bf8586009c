"""Operators put together into whole runs."""
