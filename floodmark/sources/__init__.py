"""Readers of landed documents."""
