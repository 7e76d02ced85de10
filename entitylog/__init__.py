"""Entity change tracking on Spark: snapshots -> change log -> current state."""
