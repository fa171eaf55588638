"""Composite flows and the driver query catalogue."""
