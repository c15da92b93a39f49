"""Timeline, identity and audit analytics over many recorded sessions, on Spark DataFrames."""

__version__ = "0.1.0"
