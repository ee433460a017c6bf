"""Readers and writers of book folders and item tables."""
