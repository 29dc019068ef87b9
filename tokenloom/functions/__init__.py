"""Column expressions: everything here is row-local and needs no shuffle."""
