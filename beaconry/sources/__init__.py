"""Readers and writers: envelopes, spools, typed tables and the telemetry projections of the given tables."""
