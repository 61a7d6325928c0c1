"""Readers and writers of bars."""
