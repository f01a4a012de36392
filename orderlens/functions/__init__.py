"""Reusable column expressions."""
