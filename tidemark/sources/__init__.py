"""Readers and writers: driver-table bindings, topic sources, sinks."""
