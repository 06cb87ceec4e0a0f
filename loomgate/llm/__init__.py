"""Operators on corpora and free text; optional, nothing in the core imports it."""
