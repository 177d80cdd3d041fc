"""Scans, sinks, schema tools and the star-schema views."""
