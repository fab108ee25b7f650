"""Relational operators over observations: matching, agreement, cadence, identifiers and rates."""
