"""Queries over the driver tables, one per operator, with equivalent SQL where SQL can say it."""
