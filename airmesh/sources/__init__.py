"""Readers, declared schemas, cleaning steps, stand-in tables and score sinks."""
