"""Readers of published files and pages."""
