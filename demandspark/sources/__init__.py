"""Readers, writers and the mapping of test tables to demand rows."""
