"""Reusable DataFrame operators built to stay whole under skew."""
