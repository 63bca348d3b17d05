"""Where loads write to: partitioned Parquet and published scopes."""
