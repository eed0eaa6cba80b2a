"""Registered queries, their table bindings and their SQL twins."""
