"""Flows, stand-in derivations and the registered query catalogue."""
