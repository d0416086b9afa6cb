"""Readers of events and tables."""
