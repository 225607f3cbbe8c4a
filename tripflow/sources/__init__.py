"""Readers and writers: monthly files, archives, trip events, stored tables."""
