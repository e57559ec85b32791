"""Readers and writers of raw lines, JSON messages and detection tables."""
