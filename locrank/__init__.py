"""locrank: location rankings and dataset lineage as plain PySpark DataFrame functions."""
