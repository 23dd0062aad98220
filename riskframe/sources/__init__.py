"""Readers, sinks and the materialisation cache."""
