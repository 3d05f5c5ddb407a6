"""Shared column expressions (exact money, ratios, segments, dates)."""
