"""Readers and writers. Each reader is a text scan followed by a parse_* step."""
