"""Reusable table operators that hold up under skewed keys."""
