"""The same column expressions on streams."""
