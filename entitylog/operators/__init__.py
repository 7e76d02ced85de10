"""Relational operators over snapshots, state and the change log."""
