"""Where loads read from: SQL extracts and published slices."""
