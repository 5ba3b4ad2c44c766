"""Scalar helpers: time zones / offsets and the ordered classification rules."""
