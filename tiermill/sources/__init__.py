"""Landed files and the curated CSV hand-off."""
