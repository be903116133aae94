"""Reusable DataFrame → DataFrame operators."""
