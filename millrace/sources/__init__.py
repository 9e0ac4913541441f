"""Payload readers, cursors and sinks."""
