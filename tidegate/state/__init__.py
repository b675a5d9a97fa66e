"""Control and audit state as append-only parquet logs."""
