"""Derived inputs, registered queries and their SQL twins."""
