"""Keyed feature export."""
