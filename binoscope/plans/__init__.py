"""Bindings to the star-schema tables, the registered queries and their SQL twins."""
