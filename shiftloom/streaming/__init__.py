"""Continuous form of the realtime snapshot."""
