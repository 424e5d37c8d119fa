"""Operators over any DataFrame."""
