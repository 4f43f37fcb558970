"""Whole jobs and what they need of a session."""
