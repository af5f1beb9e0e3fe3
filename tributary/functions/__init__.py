"""Column helpers. Every helper is a composition of built-in functions."""
