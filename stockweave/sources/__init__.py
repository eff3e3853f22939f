"""Readers and writers, and the mapping of the given test tables onto the retail domain."""
