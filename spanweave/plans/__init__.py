"""Composite jobs: the stages of a session run, comparison and redaction."""
