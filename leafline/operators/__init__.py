"""Relational operators: joins, roll-ups, windows, assignments."""
