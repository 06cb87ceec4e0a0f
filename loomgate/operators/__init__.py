"""Relational operators; each module holds one family."""
