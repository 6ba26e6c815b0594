"""Registered queries, one per operator, with the SQL of the same rows."""
