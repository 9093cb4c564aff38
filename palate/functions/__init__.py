"""Column expressions. Everything here is narrow: Column in, Column out, no shuffle."""
