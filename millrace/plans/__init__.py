"""Declared pipelines: specification, lint, inference, execution, and the query catalogue."""
