"""Joins, duplicates, consolidation, calendars, versioned dimensions, fact and payload."""
