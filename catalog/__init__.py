"""Registered queries: each runs one operator over inputs derived from the given tables, with its SQL counterpart."""
