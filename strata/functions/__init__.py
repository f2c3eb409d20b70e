"""Cleaning rules as Column -> Column functions. All of them are ANSI-safe: bad input gives NULL, never an error."""
