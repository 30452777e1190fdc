"""Waymark: a catalogue, entity-resolution and geo-analytics engine on PySpark."""
