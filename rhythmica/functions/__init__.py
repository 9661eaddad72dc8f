"""Column builders: calendar parts, forecast errors, cleaning and factor rules."""
