"""Snapshot and change-log tables: reading and writing."""
