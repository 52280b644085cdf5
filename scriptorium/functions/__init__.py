"""Part of the structured-text engine."""
