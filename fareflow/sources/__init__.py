"""Readers of landing files and price documents."""
