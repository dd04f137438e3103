"""Column expressions. All stay inside Catalyst."""
