"""Readers and writers; everything that touches files is here or in plans."""
