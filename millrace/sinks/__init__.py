"""Writers, table definitions and metrics."""
