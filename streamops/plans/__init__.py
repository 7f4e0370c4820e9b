"""Reusable DataFrame plans that Catalyst does not provide by itself."""
