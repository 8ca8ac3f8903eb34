"""Column expressions. Everything here returns a plain ``Column``."""
