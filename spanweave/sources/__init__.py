"""Readers and writers of the documents and logs a session comes with."""
