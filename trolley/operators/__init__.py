"""Relational and per-user operators over cart events."""
