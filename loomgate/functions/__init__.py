"""Column expressions and driver-side sizing helpers."""
