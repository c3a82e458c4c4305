"""Readers from raw files to typed frames, and writers of the results."""
