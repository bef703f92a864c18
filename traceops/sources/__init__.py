"""Readers of trace files, events and timing files; writers of results and events."""
